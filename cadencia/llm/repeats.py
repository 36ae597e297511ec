"""Removal of long repeated byte strings: winnowing finds where they may be, run-length indexes decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm import bloom
from cadencia.llm.common import as_bytes, bounded_batches
from cadencia.llm.rindex import RunIndex
from cadencia.session import materialize

GRAM = 24
#: A segment has at most so many windows; a text is hashed in blocks of so many bytes.
SEGMENT_WINDOWS = 512
BLOCK = 1 << 16
#: Bytes of segments indexed together, and of one anchor's segments beyond which its windows are compared by shuffle.
BUCKET_BYTES = 1 << 19
ANCHOR_BYTES = 1 << 20

#: A segment has so many keys; two segments of an anchor that share a window share a key.
KEYS = 3

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


_POWER, _BACK = _powers(_ODD, BLOCK + 4096), _powers(_INVERSE, BLOCK + 4096)


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWER[: len(data)], out=sums[1:])
    return sums


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def _grams(sums: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(sums) - k)
    with np.errstate(over="ignore"):
        return _mixed((sums[k:] - sums[:n]) * _BACK[:n])


def gram_hashes(data: np.ndarray, k: int = GRAM) -> np.ndarray:
    """64-bit hash of every k bytes in a row: differences of prefix sums of byte * odd^position, shifted back to position 0, mixed."""
    return _grams(_prefix_sums(data), k)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[: len(values) - step], values[step:])
        have += step
    return values


class Segments:
    """Segments of pieces of texts that lie one after the other in ``data``, piece i from ``begins[i]`` on.

    Every window of ``length`` bytes has an anchor, the smallest hash of its k-grams, which equal windows share. A segment is a
    run of windows with one anchor; each window lies in exactly one. ``again``: the anchor's gram may occur in it more than
    once, without which no window of it can repeat inside it.
    """

    def __init__(self, data: np.ndarray, begins: np.ndarray, length: int):
        self.length, self.sums = length, _prefix_sums(data)
        h = _grams(self.sums, GRAM)
        low = sliding_minimum(h, length - GRAM + 1)
        inside = np.ones(len(low), bool)
        change = np.concatenate(([True], low[1:] != low[:-1]))
        # Windows that begin in one piece and end in the next are none.
        crossing = (begins[1:, None] - np.arange(1, length)).ravel()
        inside[crossing], low[crossing] = False, 0
        change[begins] = change[begins[1:] - length + 1] = True
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(low)) - 1
        first, last = first[inside[first]], last[inside[first]]
        parts = -(-(last - first + 1) // SEGMENT_WINDOWS)
        if parts.max() > 1:
            run = np.repeat(np.arange(len(parts)), parts)
            first = first[run] + SEGMENT_WINDOWS * (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts))
            last = np.minimum(last[run], first + SEGMENT_WINDOWS - 1)
        self.first, self.last, self.anchor = first, last, low[first]
        self.piece = np.searchsorted(begins, first, side="right") - 1
        # Grams that are some window's anchor, by hash; of those that return soon, the segments are looked into.
        pad = np.zeros(length - GRAM, np.uint64)
        places = np.flatnonzero(h == ~sliding_minimum(~np.concatenate((pad, low, pad)), length - GRAM + 1))
        self.places = places[np.argsort(h[places], kind="stable")]
        hashes = h[self.places]
        equal = hashes[1:] == hashes[:-1]
        number = np.concatenate(([0], np.cumsum(~equal)))
        self.number = number[np.searchsorted(hashes, self.anchor)]
        self.ordered = number * len(data) + self.places
        of = number * len(begins) + np.searchsorted(begins, self.places, side="right") - 1
        soon = (of[1:] == of[:-1]) & (np.diff(self.places) <= SEGMENT_WINDOWS + length)
        self.again = np.isin(self.number * len(begins) + self.piece, of[1:][soon]) if soon.any() else np.zeros(len(first), bool)

    def keys(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``which``, key): hashes of the anchor's gram with so many bytes to its left and so many to its right.

        A window that two segments share has x bytes left of the gram and ``length - GRAM - x`` to the right. The numbers of
        left bytes are dealt into ranges; the key of x's range holds as many bytes on either side as any window of the range.
        """
        span, size = self.length - GRAM, len(self.sums) - 1
        first, last, number = self.first[which], self.last[which], self.number[which]
        begin = np.searchsorted(self.ordered, number * size + first)
        count = np.searchsorted(self.ordered, number * size + last + span, side="right") - begin
        segment = np.repeat(np.arange(len(which)), count)
        place = self.places[np.arange(len(segment)) + np.repeat(begin - (np.cumsum(count) - count), count)]
        lefts, rights = place - first[segment], last[segment] + span - place
        cuts = [(span + 1) * i // KEYS for i in range(KEYS + 1)]
        owner, found = [], []
        for i, (left, end) in enumerate(zip(cuts, cuts[1:])):
            right = span + 1 - end
            own = np.flatnonzero((lefts >= left) & (rights >= right))
            at, k = place[own] - left, left + GRAM + right
            with np.errstate(over="ignore"):
                found.append(_mixed((self.sums[at + k] - self.sums[at]) * _BACK[at] + np.uint64(i)))
            owner.append(segment[own])
        return np.concatenate(owner), np.concatenate(found)


def cut_up(texts: list[bytes | None], length: int) -> Iterator[tuple[Segments, np.ndarray, np.ndarray]]:
    """Segments of texts, in blocks, with the number of each one's text and its start in it."""
    joined, begins, rows, offsets, size = [], [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or b"") - length + 1, BLOCK - length + 1):
            piece = text[at : at + BLOCK]  # type: ignore[index]
            if size + len(piece) > BLOCK:
                yield _block(joined, begins, rows, offsets, length)
                joined, begins, rows, offsets, size = [], [], [], [], 0
            joined.append(piece)
            begins.append(size)
            rows.append(row)
            offsets.append(at - size)
            size += len(piece)
    if joined:
        yield _block(joined, begins, rows, offsets, length)


def _block(joined: list[bytes], begins: list[int], rows: list[int], offsets: list[int], length: int) -> tuple[Segments, np.ndarray, np.ndarray]:
    found = Segments(np.frombuffer(b"".join(joined), np.uint8), np.array(begins), length)
    return found, np.array(rows)[found.piece], found.first + np.array(offsets)[found.piece]


def segments(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, n_bytes, again) of the text's segments."""
    parts = [(s.anchor, start, s.last - s.first + length, s.again) for s, _, start in cut_up([text], length)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def _ranges(marked: np.ndarray, start: int, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the marked windows, of which number 0 begins at ``start``."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [(start + int(a), start + int(b) - 1 + length) for a, b in zip(edge[::2], edge[1::2])]


def shared_windows(anchors: list[int], texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment: which of its windows may occur in another segment of its anchor or twice in itself, by their hash."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    hashes = np.concatenate([gram_hashes(joined[at : at + BLOCK], length) for at in range(0, len(joined) - length + 1, BLOCK - length + 1)])
    # Windows that begin in one segment and end in the next are none.
    counts = sizes - length + 1
    inside = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    keys = hashes[inside] ^ np.repeat(np.array(anchors, np.int64).view(np.uint64) * np.uint64(_ODD), counts)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    shared = np.zeros(len(keys), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    return np.split(shared, np.cumsum(counts)[:-1])


def repeated_windows(anchors: list[int], texts: list[bytes], again: list[bool], length: int) -> list[np.ndarray]:
    """For segments in corpus order: which of their windows occur earlier in a segment of the same anchor, or in the same one.

    What lies outside a segment's first and last window whose hash occurs twice cannot match and is left out. One run-length
    index holds the rest of all segments; symbols carry the number of their anchor, so matches stay among segments of
    one. Segments are streamed through it, except those that are the first of their anchor and cannot repeat
    themselves. A window with a long enough match is marked if the earliest place of that match lies before it.
    """
    marks = [np.zeros(len(t) - length + 1, bool) for t in texts]
    kept, ends = [], []
    for i, shared in enumerate(shared_windows(anchors, texts, length) if texts else ()):
        found = np.flatnonzero(shared)
        if len(found):
            kept.append((i, int(found[0])))
            ends.append(int(found[-1]) + length)
    number: dict[int, int] = {}
    streamed, coloured, begins, at = [], [], [], 0
    for j, ((i, low), high) in enumerate(zip(kept, ends)):
        if anchors[i] in number or again[i]:
            streamed.append(j)
        colour = number.setdefault(anchors[i], len(number))
        coloured.append(np.frombuffer(texts[i], np.uint8)[low:high].astype(np.int64) + 256 * colour)
        begins.append(at)
        at += high - low + 1
    if streamed:
        index = RunIndex(coloured, length)
        for j, (lengths, where) in zip(streamed, index.matching_statistics([coloured[j] for j in streamed], length)):
            (i, low), n = kept[j], len(coloured[j]) - length + 1
            marks[i][low : low + n] = (lengths[:n] >= length) & (index.first[where[:n]] < begins[j] + np.arange(n))
    return marks


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
    bucket_bytes: int = BUCKET_BYTES, anchor_bytes: int = ANCHOR_BYTES, max_bits: int = bloom.MAX_BITS,
) -> DataFrame:
    """One row per input row: ``doc_id, text, n_bytes, n_removed, n_spans, kept_sha256, removed`` (ranges of bytes).

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a smaller id, or before in
    the same text. Texts are UTF-8 bytes; null is empty; matches do not cross texts. ``text`` is what is left, as bytes, since a
    cut may fall inside a character. Rows that share an id and a text are one document and get equal results; rows that share
    only an id are ordered by a hash of the text. Null ids come first. An empty table gives an empty result. Other
    columns are not read.

    1. Of equal texts all but the first are removed whole; a Bloom filter lets only the first on, and seldom another, which does no harm.
    2. Texts are cut into segments by anchors that equal windows share. Bloom filters find anchors seen twice, then among their
       segments longer strings around the anchor seen twice, one of which segments that share a window share.
    3. Only those segments are shuffled, as digests. Equal segments: all but the first are removed whole.
    4. Different segments of one anchor, first copies only, go to buckets; run-length indexes mark their windows.
       An anchor with very many different segments is not sent to one task: its windows are digested and the first
       of each found by a combined aggregation.
    5. Each document gets its list of ranges and is cut. Texts are shuffled only if a Bloom filter may know their hash.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("tk", F.xxhash64(F.coalesce("text", F.lit("")), F.octet_length("text")))
    source = source.withColumn("dk", F.xxhash64("doc_id", "tk"))
    id_field = source.schema["doc_id"]

    whole = materialize(
        source.filter(F.octet_length("text") >= length).select("doc_id", "tk", "dk", F.unhex(F.md5("text")).alias("m"), F.octet_length("text").cast("long").alias("n")),
        "repeat-texts",
    )
    first_texts = materialize(
        whole.groupBy("tk", "m").agg(F.min(F.struct("doc_id", "dk")).alias("first"), F.count(F.lit(1)).alias("copies")), "repeat-first-texts",
    )
    n_bytes, n_texts = whole.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    firsts_known = spark.sparkContext.broadcast(bloom.seen_filter(first_texts.select("first.dk"), bloom.bits_for(n_texts, max_bits)))
    copied = whole.join(first_texts.filter("copies > 1"), ["tk", "m"]).filter(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select(
        "doc_id", "tk", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"),
    )

    def first_only(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(bloom.contains(firsts_known.value, batch.column("dk").to_numpy(zero_copy_only=False).view(np.uint64))))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, _, _ in cut_up(as_bytes(first_only(batch).column("text")), length):
                # Twice for a text that repeats its anchor: both segments count.
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor.view(np.int64))], names=["h"])

    expected = n_bytes * 2 // (length - GRAM + 2)
    twice = spark.sparkContext.broadcast(bloom.twice_filter(source.select("text", "dk").mapInArrow(anchors, "h long"), bloom.bits_for(expected, max_bits)))

    def suspect_segments(texts: list[bytes | None]) -> Iterator[tuple]:
        for found, row, start in cut_up(texts, length):
            taken = np.flatnonzero(bloom.contains(twice.value, found.anchor) | found.again)
            if len(taken):
                yield found, row, start, taken, *found.keys(taken)

    def suspect_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, keys in suspect_segments(as_bytes(first_only(batch).column("text"))):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["h"])

    keys_twice = spark.sparkContext.broadcast(
        bloom.twice_filter(source.select("text", "dk").mapInArrow(suspect_keys, "h long"), bloom.bits_for(expected * KEYS, max_bits))
    )

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(first_only, batches):
            texts = as_bytes(batch.column("text"))
            for found, row, start, taken, owner, keys in suspect_segments(texts):
                shared = found.again[taken]
                shared[owner[bloom.contains(keys_twice.value, keys)]] = True
                taken = taken[shared]
                row, start, size = row[taken], start[taken], found.last[taken] - found.first[taken] + length
                g = np.array([xxhash.xxh3_64_intdigest(texts[r][a : a + n]) for r, a, n in zip(row.tolist(), start.tolist(), size.tolist())], np.uint64)
                index = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(index), batch.column("tk").take(index), pa.array(found.anchor[taken].view(np.int64)), pa.array(g.view(np.int64)),
                        pa.array(start), pa.array(size), pa.array(found.again[taken]),
                    ],
                    names=["doc_id", "tk", "h", "g", "start", "size", "again"],
                )

    fields = [id_field, *[T.StructField(n, T.LongType()) for n in ("tk", "h", "g", "start", "size")], T.StructField("again", T.BooleanType())]
    found = materialize(source.mapInArrow(suspects, T.StructType(fields)), "repeat-segments")
    firsts = materialize(
        found.groupBy("h", "g").agg(F.min(F.struct("doc_id", "tk", "start")).alias("first"), F.max("size").alias("size"), F.max("again").alias("again"), F.count(F.lit(1)).alias("n")),
        "repeat-firsts",
    )
    wanted = materialize(
        firsts.groupBy("h").agg(F.count(F.lit(1)).alias("different"), F.max("again").alias("any_again"), F.sum("size").alias("bytes"))
        .filter("different > 1 or any_again"),
        "repeat-anchors",
    )
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tk") == F.col("first.tk")) & (F.col("start") == F.col("first.start"))
    copies = found.join(firsts.filter("n > 1").select("h", "g", "first"), ["h", "g"]).filter(~is_first).select(
        "doc_id", "tk", "start", (F.col("start") + F.col("size")).alias("end"),
    )
    to_read = firsts.select("h", "first.*", "size", "again").join(wanted.select("h", (F.col("bytes") > anchor_bytes).alias("wide")), "h")
    sums = wanted.agg(
        F.sum(F.when(F.col("bytes") <= anchor_bytes, F.col("bytes"))).alias("narrow"), F.count_if(F.col("bytes") > anchor_bytes).alias("wide"),
    ).first()
    lists = materialize(
        to_read.groupBy("doc_id", "tk", "wide").agg(F.collect_list(F.struct("h", "start", "size", "again")).alias("s")).select(
            F.col("doc_id").alias("d"), F.col("tk").alias("t"), "wide", "s",
        ),
        "repeat-lists",
    )

    def among(rows: DataFrame) -> Column:
        """Whether a row of the source may be one of ``rows``, so that only texts that are needed are shuffled."""
        known = spark.sparkContext.broadcast(bloom.seen_filter(rows.select("t"), bloom.bits_for(n_texts, max_bits)))

        @F.arrow_udf("boolean")
        def look_up(tk: pa.Array) -> pa.Array:
            return pa.array(bloom.contains(known.value, tk.to_numpy(zero_copy_only=False).view(np.uint64)))

        return look_up("tk")


    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = [], []
            for r, (text, listed) in enumerate(zip(as_bytes(batch.column(1)), batch.column(3).to_pylist())):
                for s in listed:
                    rows.append(r)
                    values.append((s["h"], s["start"], text[s["start"] : s["start"] + s["size"]], s["again"]))
            index = pa.array(rows, pa.int64())
            h, start, piece, again = zip(*values) if values else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(index), batch.column(2).take(index), pa.array(h, pa.int64()), pa.array(start, pa.int64()), pa.array(piece, pa.binary()), pa.array(again, pa.bool_())],
                names=["doc_id", "tk", "h", "start", "piece", "again"],
            )

    piece_fields = [id_field, *[T.StructField(n, T.LongType()) for n in ("tk", "h", "start")], T.StructField("piece", T.BinaryType()), T.StructField("again", T.BooleanType())]

    def cut_out(listed: DataFrame) -> DataFrame:
        # Rows that repeat an id and a text are one document here.
        read = source.filter(among(listed)).join(listed, source["doc_id"].eqNullSafe(F.col("d")) & (source["tk"] == F.col("t")))
        return read.select("doc_id", "text", "tk", "s").mapInArrow(pieces, T.StructType(piece_fields))

    buckets = max(1, -(-(sums.narrow or 0) // bucket_bytes))

    def index_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            h, again = whole.column("h").to_pylist(), whole.column("again").to_pylist()
            texts, start = whole.column("piece").to_pylist(), whole.column("start").to_pylist()
            # The same row twice (a repeated document) is one segment.
            keys = list(zip(h, whole.column("doc_id").to_pylist(), whole.column("tk").to_pylist(), start))
            own = [i for i in range(len(h)) if not i or keys[i] != keys[i - 1]]
            marks = repeated_windows([h[i] for i in own], [texts[i] for i in own], [again[i] for i in own], length)
            rows, begin, end = [], [], []
            for i, marked in zip(own, marks):
                for a, b in _ranges(marked, start[i], length):
                    rows.append(i)
                    begin.append(a)
                    end.append(b)
            index = pa.array(rows, pa.int64())
            taken = whole.select(["doc_id", "tk"]).take(index).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in taken.columns]
            return pa.RecordBatch.from_arrays([*columns, pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=["doc_id", "tk", "start", "end"])

        current = None
        for batch in batches:
            numbers = batch.column("bucket").to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b > a:
                    if held and numbers[a] != current:
                        yield flush()
                        held.clear()
                    current = numbers[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    range_schema = T.StructType([id_field, *[T.StructField(n, T.LongType()) for n in ("tk", "start", "end")]])
    bucketed = (
        cut_out(lists.filter("not wide")).withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
        .repartition("bucket").sortWithinPartitions("bucket", "h", "doc_id", "tk", "start")
    )
    indexed = bucketed.mapInArrow(index_buckets, range_schema)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, (piece, start) in enumerate(zip(batch.column("piece").to_pylist(), batch.column("start").to_pylist())):
                n = len(piece) - length + 1
                index = pa.array(np.full(n, r))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index), pa.array(np.arange(start, start + n)), pa.array([xxhash.xxh3_128_digest(piece[i : i + length]) for i in range(n)], pa.binary())],
                    names=["doc_id", "tk", "start", "w"],
                )

    if sums.wide:
        window_schema = T.StructType([id_field, *[T.StructField(n, T.LongType()) for n in ("tk", "start")], T.StructField("w", T.BinaryType())])
        spread = materialize(cut_out(lists.filter("wide")).mapInArrow(windows, window_schema), "repeat-windows")
        earliest = materialize(spread.groupBy("w").agg(F.min(F.struct("doc_id", "tk", "start")).alias("first")), "repeat-earliest")
        later = spread.join(earliest, "w").filter(~is_first).select("doc_id", "tk", "start", (F.col("start") + length).alias("end"))
        indexed = indexed.unionByName(later)

    ranges = (
        copied.unionByName(copies).unionByName(indexed).groupBy("doc_id", "tk").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("r"))
        .select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), F.col("r.start").alias("begins"), F.col("r.end").alias("ends"))
    )
    ranges = materialize(ranges, "repeat-ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text, begins, ends in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                text, spans = text or b"", []
                for a, b in zip(begins or (), ends or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                rest = b"".join([*kept, text[at:]])
                values = (rest, len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [{"start": a, "end": b} for a, b in spans])
                for column, value in zip(out, values):
                    column.append(value)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    has_ranges = among(ranges)
    joined = (
        source.filter(has_ranges).join(ranges, source["doc_id"].eqNullSafe(F.col("d")) & (source["tk"] == F.col("t")), "left").select("doc_id", "text", "begins", "ends")
        .unionByName(source.filter(~has_ranges).select("doc_id", "text"), allowMissingColumns=True)
    )
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return joined.mapInArrow(cut, T.StructType([
        id_field, T.StructField("text", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
        T.StructField("kept_sha256", T.StringType()), T.StructField("removed", T.ArrayType(span)),
    ]))
