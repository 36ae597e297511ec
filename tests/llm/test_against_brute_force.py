"""Operators that SQL cannot express, against plain versions, on whole small tables and on made-up hard cases."""

import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from cadencia.llm import simhash as near
from cadencia.llm.mixing import mix
from cadencia.llm.pii import KINDS, base_spans, find_pii
from cadencia.llm.queries import QUERIES
from cadencia.llm.repeats import remove_repeats, segments
from cadencia.llm.rindex import RunIndex
from cadencia.llm.simhash import near_dedup

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text, source from '{SF}/documents.parquet' order by doc_id").fetchall()


def hard_texts(seed, n=60):
    """Texts that share passages, repeat themselves, and hold periods."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = [rng.choice([word(), rng.choice(passages), word() * rng.randrange(1, 90)]) for _ in range(rng.randrange(0, 9))]
        out.append(" ".join(parts))
    return [*out, "", None, out[0], out[1] + "x", "a" * 3000, "ab" * 700 + "c" * 99, "a" * 150]


def test_repeats_on_whole_table(spark, documents):
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_repeats"](spark, SF).collect()}
    assert rows == brute.repeats([(d, t) for d, t, _ in documents])


@pytest.mark.parametrize("anchor_bytes", [1 << 21, 0])
def test_repeats_in_hard_texts(spark, anchor_bytes):
    rows = list(enumerate(hard_texts(1)))
    found = remove_repeats(spark.createDataFrame(rows, DOCS), anchor_bytes=anchor_bytes, bucket_bytes=3000).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute.repeats(rows)
    for r in found:
        assert brute.sha(r.text) == r.kept_sha256 and sum(s.end - s.start for s in r.removed) == r.n_removed


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    for _ in range(60):
        text = bytes(rng.choice(b"abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(90, 1500)))
        _, start, size, again = segments(text, 100)
        windows = []
        for a, n, may_repeat in zip(start.tolist(), size.tolist(), again):
            inside = [text[w : w + 100] for w in range(a, a + n - 99)]
            assert may_repeat or len(set(inside)) == len(inside)
            windows += range(a, a + n - 99)
        assert windows == list(range(max(0, len(text) - 99)))


def test_run_index_gives_matching_statistics():
    rng = random.Random(3)

    def longest(texts, pattern, i):
        n = 0
        while i + n < len(pattern) and any(pattern[i : i + n + 1] == t[j : j + n + 1] for t in texts for j in range(len(t) - n)):
            n += 1
        return n

    for _ in range(40):
        k = rng.randrange(1, 4)
        texts = [[rng.randrange(k) for _ in range(rng.randrange(1, 25))] for _ in range(rng.randrange(1, 4))]
        patterns = [[rng.randrange(k + 1) for _ in range(rng.randrange(1, 15))] for _ in range(3)]
        found = RunIndex([np.array(t, np.int64) for t in texts]).matching_statistics([np.array(p, np.int64) for p in patterns], 99)
        assert [f.tolist() for f, _ in found] == [[longest(texts, p, i) for i in range(len(p))] for p in patterns]


def test_run_index_leads_to_the_earliest_place():
    rng = random.Random(8)
    for length in (3, 5, 6, 7, 12):
        for _ in range(20):
            texts = [[rng.randrange(2) for _ in range(rng.randrange(1, 40))] for _ in range(rng.randrange(1, 4))]
            index = RunIndex([np.array(t, np.int64) for t in texts], length)
            text = index.text.tolist()
            seen = {}
            for at in range(len(text) - length + 1):
                window = tuple(text[at : at + length])
                if min(window) >= 0:
                    assert index.first[at] == seen.setdefault(window, at)


def test_simhash_on_whole_table(spark, documents):
    rows = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect()}
    assert rows == brute.components([(d, t) for d, t, _ in documents])


def test_links_of_close_fingerprints(spark, monkeypatch):
    """Chains and clusters of fingerprints at up to four bits, found whatever bits differ."""
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for f in prints[:100]:
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                g ^= 1 << b
            prints.append(g)
    rows = [(i, str(f)) for i, f in enumerate(prints)]
    monkeypatch.setattr(brute, "simhash", lambda text, words: int(text))
    as_long = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(prints)]
    monkeypatch.setattr(near, "simhash", lambda docs, *_: spark.createDataFrame(as_long, "doc_id long, fp long"))
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in near_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == brute.components(rows)


def test_large_cluster_emits_a_forest_only():
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    cluster = {centre}
    while len(cluster) < 3000:
        cluster.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 3))) if len(cluster) < 1500 else rng.choice(list(cluster)[:50]) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    edges = near._forest(np.array(sorted(cluster), np.uint64), 4)
    assert len(edges) == len(cluster) - 1


def test_personal_data_on_whole_table(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_pii"](spark, SF).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        spans, row = brute.personal(text), rows[doc_id]
        listed = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
        assert row.base_sha256 == brute.sha(",".join(listed).encode())
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(x[1] == k for x in spans) for k in range(4)]
        assert set(listed) <= set(row.spans.split(","))


def test_base_spans_of_hard_texts():
    rng = random.Random(6)
    alphabet = ["1", "9", "25", "300", ".", "..", "-", " ", "+", "(", ")", "@", "a.b", "é", "x@y.z", "4111 1111 1111 1111", "\n", "_", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25)))
        assert base_spans(text)[0] == brute.personal(text), text
    long = "9" * 200_000 + " " + "a" * 200_000 + "@ " + "1." * 50_000
    assert base_spans(long)[0] == [(s, 1, e) for s, k, e in base_spans("1." * 50_000)[0] for s, e in [(s + 400_003, e + 400_003)]]


def test_proposed_spans_are_voted_on(spark):
    plain = [(i, f"word {i} call me at (555) 123-4{i % 10}67 or +1 (555) 123-4{i % 10}67 today") for i in range(40)]
    secret = [(100 + i, f'the token = "{i:02d}ab34cd56ef78ab90cd12ef34ab56cd78ef90ab" end') for i in range(20)]
    rows = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame([*plain, *secret, (999, "nothing here"), (1000, None)], DOCS)).collect()}
    assert all("phone:18:32" in rows[i] and "phone:36:53" in rows[i] or i >= 10 for i, _ in plain)
    assert all(rows[i].startswith("secret:13:") for i, _ in secret)
    assert rows[999] == rows[1000] == ""


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_on_whole_table(spark, documents):
    runs = [sorted(map(tuple, QUERIES["op3_mixing"](spark, SF).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in documents:
        sizes[source] += words(text)
    expected = brute.targets(sizes)
    for doc_id, size, source_size, target, got, source, copies in runs[0]:
        assert size == words(documents[doc_id][1]) and source_size == sizes[source]
        assert target == pytest.approx(expected[source]) and got == copies * size and 0 <= copies <= 3
        taken[source] += got
    largest = {s: max(words(t) for _, t, x in documents if x == s) for s in sizes}
    assert all(abs(taken[s] - expected[s]) <= max(20, 0.6 * largest[s]) for s in sizes)


def test_mix_caps_and_reshares(spark):
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate(["a"] * 300 + ["b"] * 5 + [None] * 40 + ["c"] * 4)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), group_rows=50).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    expected = brute.targets(sizes)
    assert {r.source: round(r.target, 6) for r in found} == {s: round(t, 6) for s, t in expected.items()}
    assert all(abs(taken[s] - expected[s]) <= 8 for s in sizes)
    assert expected["b"] == 3 * sizes["b"] == taken["b"]


def test_quality_on_rows_never_learnt_from(spark):
    labels = dict(duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = QUERIES["op2_quality"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    good, bad = [], []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in labels:
            (good if labels[r.doc_id] else bad).append(r.score)
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean(np.array(good) >= 0.3) > 0.97 and np.mean(np.array(bad) < 0.3) > 0.7


def test_mix_with_one_long_text_in_every_group(spark):
    # Ten groups; the long texts have most of the words, and no group can take up the error of one.
    rows = [(i, "w " * (3_000 if i % 200 == 0 else 3), "a") for i in range(2_000)] + [(9_000 + i, "w " * 1_200, "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs, weights=(1, 3), most=3, group_rows=200).collect()
    assert len(found) == len(rows)
    for source in "ab":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= (30 if source == "a" else 600)
