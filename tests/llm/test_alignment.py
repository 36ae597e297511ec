"""Alignment of two tokenizers against a plain version that compares whole texts token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadencia.llm import alignment
from cadencia.llm.alignment import Aligner, align, byte_alphabet, token_links
from cadencia.llm.queries import QUERIES
from cadencia.llm.tokens import read_vocabulary

SF = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string"

ODD = [
    None, "", " ", "  ", "\n", "a", "a  b", " a", "a ", "a\n b", "a \n b", "a\n\n\nb c", "tab\tx  y", "▁", "a ▁b", "a▁ b", "x <|endoftext|> y", "<s> z </s> <unk>", "<0x41> <0xC3>",
    "é ́e 👩‍👩‍👧 ok", "日本語 テスト 한국어", "\x00 a\x00", "it's we'll 12345 don't", "nbsp x  y  z　", "a\x1c b \x1dc", "ab" * 20_000, "word " * 9000, "\u0085 x\u0085 y",
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.alphabet = byte_alphabet()

    def tokens(self, text):
        raw = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        bytes_a = [bytes(self.alphabet[c] for c in t) for t in a.tokens]
        bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return [], []
        return [list(zip(ids, np.cumsum([len(t) for t in tokens]).tolist())) for ids, tokens in ((a.ids, bytes_a), (b, bytes_b))]

    def rows(self, docs):
        described, counts = [], Counter()
        for doc_id, text in docs:
            a, b = self.tokens(text or "")
            links, at = [], 0
            for i, (x, end) in enumerate(a):
                begin = a[i - 1][1] if i else 0
                while at < len(b) and b[at][1] <= begin:
                    at += 1
                j = at
                while j < len(b) and (b[j - 1][1] if j else 0) < end:
                    links.append((x, b[j][0]))
                    j += 1
            both = {e for _, e in a} & {e for _, e in b}
            groups, i, j = [], 0, 0
            for end in sorted(both):
                parts = []
                for side, k in ((a, i), (b, j)):
                    ids = []
                    while k < len(side) and side[k][1] <= end:
                        ids.append(str(side[k][0]))
                        k += 1
                    parts.append((",".join(ids), k))
                (left, i), (right, j) = parts
                groups.append(f"{left}|{right}")
            described.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
            counts.update(set(links))
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        return Counter(
            (doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), groups)
            for doc_id, n_a, n_b, n_groups, links, groups in described
        )


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_whole_table(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_alignment"](spark, SF).collect()
    expected = Counter((*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "") for row in plain.rows(docs))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found) == expected


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_hard_rows(spark, plain, broadcast_pairs):
    docs = [*enumerate(ODD), (None, "no id"), (3, "a b a b"), (3, "a b a b")]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    for clash in ("pair", "n", "best", "row", "links", "groups", "id_a", "most", "n_a"):
        frame = frame.withColumn(clash, F.lit(None).cast("int"))
    found = Counter(tuple(r) for r in align(frame, A, B, broadcast_pairs=broadcast_pairs).collect())
    assert found == plain.rows(docs)


def test_empty_table(spark):
    assert not align(spark.createDataFrame([], SCHEMA), A, B).collect()
    assert not align(spark.createDataFrame([], SCHEMA), A, B, broadcast_pairs=-1).collect()


def test_words_align_as_whole_texts(plain, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_WORDS", 300)  # words beyond these are dropped and learnt anew
    aligner = Aligner(read_vocabulary(A), read_vocabulary(B))
    rng = random.Random(1)
    bits = [*"abE.,'!\n\t1  ", "é", "▁", "the", "'s", "<|endoftext|>", " ", "日", "\x1c"]
    for _ in range(40):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(50)]
        word, ends = aligner.words(texts)
        begin = 0
        for text, end in zip(texts, ends.tolist()):
            (expected,) = plain.rows([(0, text)])
            mine = word[begin:end]
            assert "".join(aligner.groups[i] for i in mine)[:-1] == expected[-1], repr(text)
            assert aligner.counts[mine, :4].sum(axis=0).tolist() == list(expected[1:5])
            begin = end


def test_pointer_jumping_on_random_cuts():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.flatnonzero(np.append(rng.random(n - 1) < p, True)) + 1 for p in rng.random(2)]
        begins = [np.concatenate(([0], e[:-1])) for e in ends]
        a, b, group_a, group_b = token_links(begins[0], ends[0], begins[1], ends[1])
        pairs = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if begins[0][i] < ends[1][j] and begins[1][j] < ends[0][i]}
        assert len(a) == len(pairs) and set(zip(a.tolist(), b.tolist())) == pairs
        cuts = np.intersect1d(*ends)
        assert group_a.tolist() == np.searchsorted(cuts, ends[0]).tolist() and group_b.tolist() == np.searchsorted(cuts, ends[1]).tolist()
    # One group of tokens that overlap in a chain of 100,000.
    a, b, group_a, group_b = token_links(*(np.array(x) for x in (range(0, 200_000, 2), range(2, 200_002, 2), [0, *range(1, 200_000, 2)], [*range(1, 200_000, 2), 200_000])))
    assert not group_a.any() and not group_b.any()
