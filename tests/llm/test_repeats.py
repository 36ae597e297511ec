import numpy as np

from cadencia.llm import repeats
from tests.llm import brute


def _brute(anchors, texts, length):
    seen, marks = set(), []
    for anchor, text in zip(anchors, texts):
        keys = [(anchor, text[i : i + length]) for i in range(len(text) - length + 1)]
        marks.append([k in seen or seen.add(k) is not None for k in keys])
    return marks


def test_only_windows_that_may_repeat_are_indexed(monkeypatch):
    """op4: segments of one anchor that share no window stay out of the index, others go in from their first shared window to the last."""
    draw = np.random.default_rng(4)
    line = lambda n: draw.integers(0, 256, n).astype(np.uint8).tobytes()
    common, loop = line(120), line(40)
    anchors = [-5, -5, -5, 9, 9, 7, 7, 3]
    texts = [line(30) + common + line(20), common + line(90), line(100), line(300), line(250), common, common + line(1), loop * 4]
    again = [False] * 7 + [True]
    sizes, index = [], repeats.RunIndex
    monkeypatch.setattr(repeats, "RunIndex", lambda coloured, length: sizes.append([len(c) for c in coloured]) or index(coloured, length))
    marks = repeats.repeated_windows(anchors, texts, again, 100)
    assert [m.tolist() for m in marks] == _brute(anchors, texts, 100)
    assert sizes == [[120, 120, 120, 120, 160]]  # before: all 1,131 bytes and more


def test_windows_across_hash_blocks(monkeypatch):
    draw = np.random.default_rng(5)
    texts = [bytes(draw.integers(97, 100, int(n)).astype(np.uint8)) for n in draw.integers(100, 700, 60)]
    texts += [t[20:] + t[:50] for t in texts[:30]]
    texts = [t for t in texts if len(t) >= 100]
    anchors = [i % 30 for i in range(60)] + [i % 30 for i in range(len(texts) - 60)]
    monkeypatch.setattr(repeats, "BLOCK", 1024)
    marks = repeats.repeated_windows(anchors, texts, [True] * len(texts), 100)
    assert [m.tolist() for m in marks] == _brute(anchors, texts, 100)
    assert repeats.repeated_windows([], [], [], 100) == []


def test_segments_that_share_a_window_share_a_key():
    """op4: whatever lies around the anchor, in texts that repeat themselves and in blocks of several texts."""
    draw = np.random.default_rng(6)
    texts = [bytes(draw.integers(97, 97 + k, int(n)).astype(np.uint8)) for k in (1, 2, 3, 26) for n in draw.integers(100, 900, 8)]
    texts += [t[:150] + texts[i - 1] + t[40:] for i, t in enumerate(texts)] + [b"ab" * 400, b"abc" * 300, None, b"a" * 99]
    for length in (100, 37, 24):
        owners, windows = {}, {}
        for found, row, start in repeats.cut_up(texts, length):
            owner, keys = found.keys(np.arange(len(found.anchor)))
            held = [set() for _ in found.anchor]
            for o, k in zip(owner.tolist(), keys.tolist()):
                held[o].add(k)
            for j, (r, a, n) in enumerate(zip(row.tolist(), start.tolist(), (found.last - found.first + 1).tolist())):
                owners[r, a] = held[j]
                for w in range(a, a + n):
                    windows.setdefault(texts[r][w : w + length], []).append((r, a))
        assert all(owners[x] & owners[at[0]] for at in windows.values() for x in at)


def test_only_what_may_repeat_is_shuffled(spark, monkeypatch):
    """op4: segments of near copies that share no window, and whole copies, are not written; before, all of them were."""
    draw = np.random.default_rng(7)
    line = lambda n: draw.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    text = line(4000)
    near = "".join("#" if i % 60 == 59 else c for i, c in enumerate(text))
    rows, count, write = [(1, text), (2, near), (3, text), (4, None), (None, near), (5, line(300))], {}, repeats.materialize

    def counted(df, label):
        written = write(df, label)
        count[label] = written.count()
        return written

    monkeypatch.setattr(repeats, "materialize", counted)
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute.repeats(rows)
    assert count["repeat-segments"] == 0 and count["repeat-lists"] == 0
