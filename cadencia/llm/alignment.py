"""Alignment of two tokenizers on the bytes of the same text, by pointer jumping over overlapping tokens."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import as_bytes, bounded_batches
from cadencia.llm.tokens import from_json, read_vocabulary
from cadencia.session import materialize

#: Id pairs whose counts are sent to every task (24 bytes each); more are joined instead.
BROADCAST_PAIRS = 1 << 21
#: About so many words' alignments a worker keeps, the first it meets; later words it has at hand for one slice.
KEPT_WORDS = 300_000
#: Different id pairs a worker tells apart before it starts afresh.
KEPT_PAIRS = 1 << 22
#: New words encoded as one text, and bytes of texts aligned together.
LEARNED = 50_000
SLICE_BYTES = 1 << 21
#: Cells of a table of texts and pairs.
CELLS = 1 << 25

_B_IDS = 1 << 20

#: A single space between two characters that are not blank: both tokenizers begin a token there.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself where it is one, else the next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes by a byte-level tokenizer file."""

    def __init__(self, vocabulary: bytes):
        self.tokenizer = from_json(vocabulary, plain_specials=True)
        alphabet = byte_alphabet()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Ids and token bytes by a sentencepiece model, which puts a space in front itself."""

    def __init__(self, vocabulary: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        #: No piece holds a space behind another character, so none reaches across one.
        self.parts_at_spaces = not any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size()))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def token_links(begin_a: np.ndarray, end_a: np.ndarray, begin_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, group of a, group of b): all pairs of tokens whose byte ranges overlap, and the numbers of the groups, in order.

    Tokens of A and of B each cover the same bytes without gaps. Every token points to its farthest-right overlapping token of the other
    side, unless that one ends no later; of two that end together the one of B is the last. Successors are doubled until nothing moves:
    then every token points to the terminal token of its component, whose end is an end on both sides.
    """
    n_a, n_b = len(end_a), len(end_b)
    first = np.searchsorted(end_b, begin_a, side="right")
    last = np.searchsorted(begin_b, end_a, side="left") - 1
    successor = np.concatenate((n_a + last, np.arange(n_a, n_a + n_b)))
    far = np.searchsorted(begin_a, end_b, side="left") - 1
    moves = end_a[far] > end_b
    successor[n_a:][moves] = far[moves]
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    terminals, group = np.unique(successor, return_inverse=True)
    # Terminals are tokens of B, so their order is that of the text.
    sizes = last - first + 1
    a = np.repeat(np.arange(n_a), sizes)
    b = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    return a, b, group[:n_a], group[n_a:]


class _Numbers(dict):
    """Word -> number, the next one for a new word, and -1 for what is no word of its own: nothing, or with a blank at an end."""

    def __init__(self):
        self.new: list[str] = []
        self.known = 0

    def __missing__(self, word: str) -> int:
        if not word or word[0].isspace() or word[-1].isspace():
            self[word] = -1
            return -1
        self[word] = number = self.known + len(self.new)
        self.new.append(word)
        return number


class Aligner:
    """Alignments of words, kept from batch to batch. A word is what lies between two cuts."""

    def __init__(self, a: bytes, b: bytes):
        self.sides = (ByteLevel(a), Pieces(b))
        self.sizes = tuple(np.array([len(x) for x in side.bytes], np.int64) for side in self.sides)
        #: An id as it is written inside a group, and as its last one on this side.
        self.written = tuple(
            np.array([[f"{i}{mark}" for i in range(len(side.bytes))] for mark in (",", last)], object) for side, last in zip(self.sides, "|;")
        )
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        #: Words with blanks at their ends, which only stand at the ends of texts.
        self.edges: dict[str, int] = {}
        #: The different id pairs met, a_id * 2^20 + b_id, and the numbers they have here in increasing order.
        self.pairs, self.by_pair = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.groups: list[str] = []
        #: Per word: A tokens, B tokens, groups, links, and 1 if both sides give its bytes back.
        self.counts = np.zeros((0, 5), np.int64)
        self.codes, self.code_ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
        #: Words, entries and words with blanks that stay, once there are enough.
        self.kept: tuple[int, int, int] | None = None

    def _joined(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray] | None:
        """Ids of all words in a row on both sides, from one text of them all, and the words' ends in bytes; None if the bytes do not come back."""
        text = " ".join(words)
        raw = f" {text}".encode()
        flat = []
        for side in self.sides:
            (ids,) = side.encode([text])
            if b"".join([side.bytes[i] for i in ids]) != raw:
                return None
            flat.append(np.array(ids, np.int64))
        return flat, np.cumsum([len(w.encode()) + 1 for w in words])

    def _each(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The same word by word, and which bytes come back; the others have no tokens."""
        encoded, raw = [side.encode(words) for side in self.sides], [f" {w}".encode() for w in words]
        fine = [all(b"".join([side.bytes[i] for i in ids[n]]) == r for side, ids in zip(self.sides, encoded)) for n, r in enumerate(raw)]
        flat = [np.array([i for ids, ok in zip(side, fine) if ok for i in ids], np.int64) for side in encoded]
        return flat, np.cumsum([len(r) if ok else 0 for r, ok in zip(raw, fine)]), np.array(fine)

    def _learn(self) -> None:
        """Adds the new words. They have no blanks at their ends, so they are cut apart again as parts of one text."""
        new, self.number.new = self.number.new, []
        for at in range(0, len(new), LEARNED):
            some = new[at : at + LEARNED]
            joined = self._joined(some)
            if joined is not None:
                self._add(some, *joined, np.ones(len(some), bool))
            else:
                self._add(some, *self._each(some))
        self.number.known = len(self.groups)

    def _add(self, words: list[str], flat: list[np.ndarray], word_ends: np.ndarray, fine: np.ndarray) -> None:
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.sizes, flat)]
        begins = [end - size[ids] for end, size, ids in zip(ends, self.sizes, flat)]
        a, b, *group = token_links(begins[0], ends[0], begins[1], ends[1])
        # Tokens of both sides end where a word ends, so no group reaches from one word into the next.
        last = [np.searchsorted(end, word_ends, side="right") for end in ends]
        n_tokens = [np.diff(at, prepend=0) for at in last]
        group_ends = np.concatenate(([0], group[1] + 1))[last[1]]
        n_links = np.diff(np.concatenate(([0], np.cumsum(np.bincount(a, minlength=len(flat[0])))))[last[0]], prepend=0)
        parts = [
            written[np.append(of[1:] != of[:-1], True).astype(np.int64), ids] if len(ids) else np.zeros(0, object)
            for written, of, ids in zip(self.written, group, flat)
        ]
        order = np.argsort(np.concatenate((group[0] * 2, group[1] * 2 + 1)), kind="stable")
        ordered = np.concatenate(parts)[order].tolist()
        edges = [0, *(last[0] + last[1]).tolist()]
        self.groups += ["".join(ordered[x:y]) for x, y in zip(edges[:-1], edges[1:])]
        self.counts = np.concatenate([self.counts, np.stack([*n_tokens, np.diff(group_ends, prepend=0), n_links, fine.astype(np.int64)], axis=1)])
        self.code_ends = np.concatenate([self.code_ends, self.code_ends[-1] + np.cumsum(n_links)])
        self.codes = np.concatenate([self.codes, self._numbers(flat[0][a] * _B_IDS + flat[1][b])])

    def _numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of id pairs, new ones for those not met before."""
        different, inverse = np.unique(pairs, return_inverse=True)
        new = different[~np.isin(different, self.pairs)]
        if len(new):
            self.pairs = np.concatenate([self.pairs, new])
            self.by_pair = np.argsort(self.pairs)
        return self.by_pair[np.searchsorted(self.pairs, different, sorter=self.by_pair)][inverse]

    def _drop_surplus(self) -> None:
        """Back to the words that stay; dictionaries give the latest entries first."""
        if self.kept is None and len(self.number) > KEPT_WORDS:
            self.kept = len(self.groups), len(self.number), len(self.edges)
        if self.kept is not None and len(self.groups) + len(self.number) > self.kept[0] + self.kept[1]:
            words, entries, edges = self.kept
            while len(self.number) > entries:
                self.number.popitem()
            while len(self.edges) > edges:
                self.edges.popitem()
            del self.groups[words:]
            self.counts, self.code_ends = self.counts[:words].copy(), self.code_ends[: words + 1].copy()
            self.codes = self.codes[: self.code_ends[-1]].copy()
            self.number.known = words

    def _careful(self, text: str) -> list[int]:
        """Numbers of the words of a text that has blanks next to spaces or at its ends."""
        words = _CUT.split(text) if self.sides[1].parts_at_spaces else [text]
        out = []
        for word in words:
            if self.number[word] >= 0 and self.sides[1].parts_at_spaces:
                out.append(self.number[word])
                continue
            if word not in self.edges:
                self._learn()  # numbers go on from here
                self.edges[word] = len(self.groups)
                self._add([word], *self._each([word]))
                self.number.known = len(self.groups)
            out.append(self.edges[word])
        return out

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, ends): the words of the texts in a row, and where each text's end. Texts that do not come back from both sides have none."""
        self._drop_surplus()
        get, at_spaces = self.number.__getitem__, self.sides[1].parts_at_spaces
        numbers = [list(map(get, t.split(" "))) if t and at_spaces else [-1] * bool(t) for t in texts]
        for i, found in enumerate(numbers):
            if -1 in found:
                numbers[i] = self._careful(texts[i])
        self._learn()
        sizes = np.array([len(n) for n in numbers], np.int64)
        word = np.fromiter(itertools.chain.from_iterable(numbers), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        lost = np.zeros(len(texts), bool)
        lost[row[self.counts[word, 4] == 0]] = True
        if lost.any():
            word, sizes = word[~lost[row]], np.where(lost, 0, sizes)
        return word, np.cumsum(sizes)

    def links(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ends, pair numbers): the links of the words in a row, and where each word's end."""
        n = self.code_ends[word + 1] - self.code_ends[word]
        ends = np.cumsum(n)
        return ends, self.codes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.code_ends[word] - ends + n, n)]


_aligners: dict[tuple[int, int], Aligner] = {}


def _aligner(a: bytes, b: bytes) -> Aligner:
    """One per worker process and pair of vocabularies."""
    key = (zlib.crc32(a), zlib.crc32(b))
    if key not in _aligners:
        _aligners[key] = Aligner(a, b)
    return _aligners[key]


def _texts(column: pa.Array) -> list[str]:
    return [(t or b"").decode() for t in as_bytes(column)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``SLICE_BYTES`` of text (the last column), one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(x, y - x)


def _rows_with(row: np.ndarray, code: np.ndarray, rows: int, codes: int) -> np.ndarray:
    """For each code, in how many rows it occurs; ``row`` does not decrease."""
    if rows * codes > 64 * len(row):
        return np.bincount(np.unique(row * codes + code) % codes, minlength=codes)
    out, step = np.zeros(codes, np.int64), max(1, CELLS // codes)
    for at in range(0, rows, step):
        x, y = np.searchsorted(row, (at, at + step))
        met = np.zeros((min(step, rows - at), codes), bool)
        met[row[x:y] - at, code[x:y]] = True
        out += met.sum(axis=0)
    return out


def _link_rows(aligner: Aligner, word: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, pair number) of all links."""
    link_ends, code = aligner.links(word)
    of_text = np.diff(np.concatenate(([0], link_ends))[ends], prepend=0)
    return np.repeat(np.arange(len(ends)), of_text), code


def _count_pairs(a: bytes, b: bytes):
    """Id pairs of each task's texts and in how many of them they are linked."""

    def counted(aligner: Aligner, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        met = np.flatnonzero(times)
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(aligner.pairs[met]), pa.array(times[met])], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b)
        times = np.zeros(0, np.int64)
        for batch in _slices(batches):
            if len(aligner.pairs) > KEPT_PAIRS:
                yield from counted(aligner, times)
                aligner.forget()
                times = times[:0]
            row, code = _link_rows(aligner, *aligner.words(_texts(batch.column(0))))
            n = len(aligner.pairs)
            if n:
                more = _rows_with(row, code, batch.num_rows, n)
                more[: len(times)] += times
                times = more
        yield from counted(aligner, times)

    return run


_SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)


def _describe(a: bytes, b: bytes, counted: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
    """Per text its sums and groups; with ``counted`` (pairs in order, counts, 1 for the highest) also what depends on the counts, else its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b)
        for batch in _slices(batches):
            word, ends = aligner.words(_texts(batch.column(1)))
            columns = [batch.column(0), *[pa.array(_per_text(aligner.counts[word, i], ends)) for i in range(len(_SUMS))]]
            groups = list(map(aligner.groups.__getitem__, word.tolist()))
            edges = [0, *ends.tolist()]
            columns.append(pa.array(["".join(groups[x:y])[:-1] for x, y in zip(edges[:-1], edges[1:])], pa.string()))
            if counted is not None:
                pairs, times, best = counted
                # Pairs of words that only other queries of this worker met have no count; no text here holds them.
                found = np.minimum(np.searchsorted(pairs, aligner.pairs), max(0, len(pairs) - 1))
                link_ends, code = aligner.links(word)
                for values in (best, times):
                    per_link = (values[found] if len(pairs) else np.zeros(len(found), np.int64))[code]
                    columns.append(pa.array(_per_text(_per_text(per_link, link_ends), ends)))
                names = ["n_best", "count_sum"]
            else:
                row, code = _link_rows(aligner, word, ends)
                n = max(1, len(aligner.pairs))
                once, times = np.unique(row * n + code, return_counts=True)
                listed = pa.StructArray.from_arrays([pa.array(aligner.pairs[once % n] if len(once) else once), pa.array(times)], names=["pair", "times"])
                columns.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(once // n, np.arange(len(ends) + 1)), pa.int32()), listed))
                names = ["links"]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_SUMS, "groups", *names])

    return run


def pair_counts(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """``pair, n, best``: in how many rows of ``docs`` (``text``) an id pair is linked, and whether no pair of its A id is in more."""
    counts = materialize(docs.select("text").mapInArrow(_count_pairs(a, b), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    id_a = F.expr(f"pair div {_B_IDS}").alias("id_a")
    most = counts.groupBy(id_a).agg(F.max("n").alias("most"))
    joined = counts.select("pair", "n", id_a).join(most, "id_a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return materialize(joined, "align-best")


def align(
    docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A space and the text are tokenized by a byte-level file A, the text by a sentencepiece model B, which adds that space; special strings are plain
    text. The bytes of the tokens must be those of space and text on both sides; other texts, null and empty ones have no tokens: zeros and an
    empty string. Offsets where tokens of both sides end cut them into ``groups``, written ``a1,a2|b1;a3|b2,b3``. Links are all pairs
    of an A and a B token whose bytes overlap. A pair of ids counts the rows that hold it linked; ``n_best`` are the links
    whose count no other pair of the A id exceeds, ``count_sum`` adds up the counts. Every row counts, also if its id
    or text repeats; an empty table gives an empty result; other columns are not read.

    Both tokenizers begin a token at a single space between other characters, so workers align each different word once
    and keep it. Pairs are counted per task before the shuffle. There are as many pairs as the two vocabularies allow, not as the
    corpus holds words: up to ``broadcast_pairs`` of them go to every task with their counts, and no text is shuffled.
    Beyond that each row's pairs are joined with the counts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    a, b = read_vocabulary(vocabulary_a), read_vocabulary(vocabulary_b)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = pair_counts(source, a, b)
    id_field = source.schema["doc_id"]
    base = [id_field, *[T.StructField(n, T.LongType()) for n in _SUMS], T.StructField("groups", T.StringType())]
    longs = [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")]
    names = [f.name for f in (id_field, *base[1:-1], *longs)] + ["groups"]
    if counts.count() <= broadcast_pairs:
        table = counts.toArrow().sort_by("pair")
        pairs, times, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
        return source.mapInArrow(_describe(a, b, (pairs, times, best.astype(np.int64))), T.StructType([*base, *longs])).select(*names)
    link = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())]))
    described = source.mapInArrow(_describe(a, b, None), T.StructType([*base, T.StructField("links", link)]))
    described = materialize(described.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    each = described.select("row", F.explode("links").alias("l")).select("row", "l.pair", "l.times").join(counts, "pair")
    sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    joined = described.join(sums.withColumnRenamed("row", "of_row"), F.col("row") == F.col("of_row"), "left")
    return joined.select(*[F.coalesce(n, zero).alias(n) if n in ("n_best", "count_sum") else F.col(n) for n in names])
