"""Packing: every piece against the tokenizer itself, sequences read back, and how full they are."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadencia.llm.packing import nonnegative_least_squares, pack, patterns, plan, sequences
from cadencia.llm.queries import QUERIES
from cadencia.llm.tokens import WordIds, read_vocabulary

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"

ODD = [
    "", " \t\n ", None, "a b \x1c c\x0bd e\x85f", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>.", "ΑΣ ΣΑΣ. ΑΣ", "é ́e Ét́ A.́", "it's we'll 'll don't'. 12 3rd",
    " x　y​z", "İI ﬁ ẞß ÿŸ ÷× Ünï-CÖDÉ!?", "👩‍👩‍👧 ok", "\x00 a\x00", "a" * 30_000, "word " * 9000, "Word. word, (word) _word_ wo_rd \"WORD\"",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def expected_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def best_fit(lengths, size):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, n = size, n + 1
        bisect.insort(rooms, room - length)
    return n


def checked(rows, texts, tokenizer, size):
    """Every piece is there once and right; sequences have no gaps. Returns their number."""
    pieces, spans = Counter(), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        spans[r.sequence_id].append((r.offset, r.length))
    wanted = Counter()
    for doc_id, text in texts:
        ids = np.array(expected_ids(tokenizer, text), "<u4")
        for p, at in enumerate(range(0, len(ids), size)):
            wanted[doc_id, p, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes())] += 1
    assert pieces == wanted
    for placed in spans.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= size
    return len(spans)


def test_whole_table(spark, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op12_packing"](spark, SF).collect()
    assert checked(rows, texts, tokenizer, 4096) <= best_fit([r.length for r in rows], 4096) + 1


@pytest.mark.parametrize("size", [4096, 7, 1])
def test_hard_rows(spark, tokenizer, size):
    short = [t for t in ODD if size > 1 or len(t or "") < 1000]
    texts = [*enumerate(short), (1, ODD[4]), (1, ODD[4]), (None, "no id"), *[(100 + i, "same length") for i in range(500)]]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(5)
    rows = pack(docs, VOCABULARY, size=size).collect()
    assert checked(rows, texts, tokenizer, size) <= best_fit([r.length for r in rows], size) + 1
    for clash in ("ids", "length", "part", "nth", "rank", "n", "before", "offset", "piece"):
        docs = docs.withColumn(clash, F.lit(None).cast("int"))
    assert checked(pack(docs, VOCABULARY, size=size).collect(), texts, tokenizer, size)


def test_sequences_hold_the_documents(spark, tokenizer):
    texts = list(enumerate(ODD))
    packed = pack(spark.createDataFrame(texts, SCHEMA), VOCABULARY, size=64, with_ids=True)
    pieces = defaultdict(dict)
    for r in packed.collect():
        pieces[r.doc_id][r.start] = r.ids
    assert {d: sum((p[k] for k in sorted(p)), []) for d, p in pieces.items()} == {d: expected_ids(tokenizer, t) for d, t in texts}
    for r in sequences(packed).collect():
        assert len(r.ids) == sum(r.lengths) <= 64 and len(r.doc_ids) == len(r.lengths)
        at = 0
        for doc_id, length in zip(r.doc_ids, r.lengths):
            assert r.ids[at : at + length] in pieces[doc_id].values()
            at += length


def test_empty_table(spark):
    assert not pack(spark.createDataFrame([], SCHEMA), VOCABULARY).collect()


def test_words_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(1)
    encoder = WordIds(read_vocabulary(VOCABULARY))
    bits = [*"aZéÉß÷'.,!_<|> \n\t 1", "'s", "'ll", "<|endoftext|>", "İ", "́", "word", "Œ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def sequences_of(histogram, size, classes):
    """Number of sequences of a plan that places every rank once, without gaps."""
    spans, rows = defaultdict(list), plan(histogram, size, classes)
    for length, count in histogram.items():
        mine = rows[rows[:, 0] == length]
        at = np.searchsorted(mine[:, 1], np.arange(count), side="right") - 1
        for rank, (_, first, per, sequence, offset) in enumerate(mine[at].tolist()):
            spans[sequence + (rank - first) // per].append((offset + (rank - first) % per * length, length))
    for placed in spans.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= size
    assert sorted(spans) == list(range(len(spans)))
    return len(spans)


def test_plans_of_random_histograms():
    rng = random.Random(2)
    for _ in range(150):
        size = rng.randrange(1, 50)
        lengths = [rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 300))]
        found = sequences_of(dict(Counter(lengths)), size, 256)
        assert -(-sum(lengths) // size) <= found <= best_fit(lengths, size) * 1.03 + 1
        # Coarse classes waste room but place everything.
        assert sequences_of(dict(Counter(lengths)), size, rng.randrange(1, 20)) >= -(-sum(lengths) // size)


def test_patterns_beat_best_fit_where_it_does_badly():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.normal(1700, 500, 20_000).astype(int), 1, 4096).tolist()
    assert sequences_of(dict(Counter(lengths)), 4096, 256) <= best_fit(lengths, 4096)
    short = np.clip(rng.lognormal(6.3, 1.0, 20_000).astype(int), 1, 4096).tolist()
    assert sequences_of(dict(Counter(short)), 4096, 256) <= -(-sum(short) // 4096) * 1.001 + 1


def test_fit_is_nonnegative_and_optimal():
    columns = patterns(12)
    assert len({tuple(c) for c in columns.tolist()}) == len(columns) and (columns.sum(axis=1) == 12).all()
    wanted = np.random.default_rng(4).integers(0, 1000, 12).astype(float)
    weight = np.arange(1, 13) / 12
    x = nonnegative_least_squares(columns, wanted, weight)
    dense = np.zeros((13, len(columns)))
    for slot in columns.T:
        np.add.at(dense, (slot, np.arange(len(columns))), 1.0)
    a = dense[1:] * weight[:, None]
    gain = a.T @ (wanted * weight - a @ x)
    assert (x >= 0).all() and gain.max() < 1 and np.abs(gain[x > 0]).max() < 1e-6 * 1000
