"""Spelling variants against a plain version: all pairs of words compared letter by letter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadencia.llm.spelling import LONGEST_SHARD, edits, plan_rounds, spelling_variants, word_hashes

SCHEMA = "doc_id long, text string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, min_chars, min_count, ratio, damage):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(around[w]), words[form[w]] if w in form else None))
    return out


def made_up(seed):
    """Words, their misspellings, misspellings of those, and words longer than the last shard's length."""
    rng = random.Random(seed)
    rows = []
    letters = "abÀÿé×"
    for _ in range(12):
        word = "".join(rng.choice(letters) for _ in range(rng.choice([3, 4, 7, LONGEST_SHARD - 1, LONGEST_SHARD, 2 * LONGEST_SHARD])))
        times = 64
        while times:
            rows += [word] * times
            times //= rng.choice([2, 3, 4])
            i = rng.randrange(len(word))
            word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])
    rng.shuffle(rows)
    texts = [" ".join(rows[i : i + 9]).replace("a", "A", 2) for i in range(0, len(rows), 9)]
    return [*enumerate([*texts, "", None, "1 2 3", "é" * 5000 + " " + "é" * 5000 + " " + "é" * 4999 + " " + "é" * 4999]), (None, texts[0]), (3, texts[0]), (3, texts[0])]


@pytest.mark.parametrize("round_blocks, min_chars, min_count, ratio, damage", [(1 << 19, 3, 2, 2, 7), (1, 1, 1, 3, None)])
def test_against_all_pairs(spark, round_blocks, min_chars, min_count, ratio, damage):
    rows = made_up(min_chars)
    docs = spark.createDataFrame(rows, SCHEMA)
    for clash in ("word", "n", "h", "shard", "near", "form", "root", "a", "b"):
        docs = docs.withColumn(clash, F.lit(None).cast("int"))
    found = spelling_variants(docs, min_chars=min_chars, min_count=min_count, ratio=ratio, damage=damage, round_blocks=round_blocks).collect()
    expected = plain(rows, min_chars, min_count, ratio, damage)
    assert len(found) == len(expected)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == expected
    assert any(r.root not in (r.word, r.form) for r in found)  # a chain


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, ""), (None, "short")]):
        assert not spelling_variants(spark.createDataFrame(rows, SCHEMA)).collect()


def test_edits_meet_every_near_word():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(200)})
    hashes = dict(zip(words, word_hashes(words).tolist()))
    alphabet = np.array([ord(c) for c in "abc"], np.uint64)
    for w in words:
        codes = np.array([[ord(c) + 1 for c in w]], np.uint64)
        made = Counter(h for _, _, hs in edits(codes, alphabet) for h in hs.tolist())
        wanted = [v for v in words if near(w, v) and (len(v) < len(w) or (len(v) == len(w) and v > w))]
        assert all(made[hashes[v]] == 1 for v in wanted)


def test_rounds_hold_every_shard_once_and_stay_small():
    sizes = {6: 100, 7: 5_000_000, 8: 40, 64: 1}
    rounds = plan_rounds(sizes, 1 << 10)
    assert all(sum(blocks for _, blocks in r.values()) <= 1 << 10 for r in rounds)
    keys = [k for r in rounds for k in r]
    assert len(keys) == len(set(keys)) and {s for s, _ in keys} == set(sizes)
    assert all({p for s, p in keys if s == shard} == set(range(r[shard, part][0])) for r in rounds for shard, part in r)
