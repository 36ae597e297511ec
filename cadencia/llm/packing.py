"""Packing of tokenized documents into sequences: few-document patterns fitted to the histogram of lengths, the rest by best fit."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import as_bytes, bounded_batches
from cadencia.llm.tokens import WordIds, read_vocabulary
from cadencia.session import materialize

#: Lengths are fitted in so many classes; a pattern holds at most three documents whose classes fill a sequence. A document is
#: shorter than its class by up to ``size / classes``, which later documents may fill.
CLASSES = 256

_LENGTH_SHIFT = 44


def patterns(classes: int) -> np.ndarray:
    """All ways to fill ``classes`` with one, two or three of 1..classes, largest first, 0 for no document."""
    first, second = np.meshgrid(np.arange(1, classes + 1), np.arange(classes + 1), indexing="ij")
    third = classes - first - second
    fits = (first >= second) & (second >= third) & (third >= 0)
    return np.stack([first[fits], second[fits], third[fits]], axis=1)


def nonnegative_least_squares(columns: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 with the least weighted squares of ``wanted`` minus what the columns repeat (active sets after Lawson and Hanson).

    A column is up to three row numbers from 1, 0 for none; rows are weighted by ``weight``.
    """
    n = len(wanted)

    def gather(values: np.ndarray) -> np.ndarray:
        return np.concatenate(([0.0], values))[columns].sum(axis=1)

    def matrix(which: list[int]) -> np.ndarray:
        out = np.zeros((n + 1, len(which)))
        for slot in columns[which].T:
            np.add.at(out, (slot, np.arange(len(which))), 1.0)
        return out[1:] * weight[:, None]

    target = wanted * weight
    x = np.zeros(len(columns))
    active: list[int] = []
    blocked = np.zeros(len(columns), bool)
    for _ in range(4 * n if len(columns) else 0):
        left = target - matrix(active) @ x[active] if active else target
        gain = gather(left * weight)
        gain[active] = -1.0
        gain[blocked] = -1.0
        best = int(gain.argmax())
        # A column that cannot settle a tenth of a document is not worth an entry.
        if gain[best] <= 0.1 * gather(weight**2)[best]:
            break
        active.append(best)
        while True:
            a = matrix(active)
            solved = np.linalg.lstsq(a, target, rcond=None)[0]
            if (solved > 0).all():
                x[active] = solved
                break
            before = x[active]
            falling = solved <= 0
            if before[-1] == 0 and solved[-1] <= 0:  # it cannot grow: rounding of the gain
                blocked[active.pop()] = True
                break
            share = (before[falling] / (before[falling] - solved[falling])).min()
            x[active] = np.maximum(before + share * (solved - before), 0.0)
            keep = [i for i in active if x[i] > 1e-9]
            x[[i for i in active if i not in set(keep)]] = 0.0
            active = keep
            if not active:
                break
    return x


@dataclass
class _Group:
    """Equal sequences: ``runs`` are (length, first rank, documents per sequence), each sequence taking the next ranks."""

    count: int
    room: int
    runs: list[tuple[int, int, int]] = field(default_factory=list)


def plan(histogram: dict[int, int], size: int, classes: int = CLASSES) -> np.ndarray:
    """Where documents go, by length and rank among those of the length: rows (length, first rank, per, first sequence, offset).

    The documents of rank ``first rank`` and up go into sequences from ``first sequence`` on, ``per`` into each, one after the other from ``offset``.
    Everything here is about the histogram, at most ``size`` numbers, however many documents there are.
    """
    classes = min(classes, size)
    left = dict(histogram)
    lengths = sorted(left)
    taken = dict.fromkeys(lengths, 0)

    def take(length: int, n: int) -> int:
        rank = taken[length]
        taken[length] += n
        left[length] -= n
        return rank

    def largest(low: int, high: int) -> int | None:
        """The largest length that is left in low..high."""
        for i in range(bisect.bisect_right(lengths, high) - 1, -1, -1):
            if lengths[i] < low:
                return None
            if left[lengths[i]]:
                return lengths[i]
        return None

    class_of = {n: -(-n * classes // size) for n in lengths}
    bounds = {c: ((c - 1) * size // classes + 1, c * size // classes) for c in range(1, classes + 1)}
    wanted = np.zeros(classes)
    for n, count in left.items():
        wanted[class_of[n] - 1] += count
    columns = patterns(classes)
    present = np.concatenate(([True], wanted > 0))
    columns = columns[present[columns].all(axis=1)]
    # A document counts by its tokens, so the fit follows the long ones; many short ones are left, which fill gaps well.
    repeats = np.rint(nonnegative_least_squares(columns, wanted, np.arange(1, classes + 1) / classes)).astype(np.int64)

    groups: list[_Group] = []
    for which in np.argsort(-repeats, kind="stable").tolist():
        todo, of = int(repeats[which]), [c for c in columns[which].tolist() if c]
        while todo:
            used: dict[int, int] = {}
            chosen, room = [], size
            for i, c in enumerate(of):
                low, high = bounds[c]
                # The last one may come from above its class, as close as possible to what is left of the sequence.
                length = largest(low, room if i == len(of) - 1 and i else min(high, room))
                if length is None or left[length] <= used.get(length, 0):
                    break
                used[length] = used.get(length, 0) + 1
                chosen.append(length)
                room -= length
            if len(chosen) < len(of):
                break
            n = min(todo, *(left[length] // k for length, k in used.items()))
            groups.append(_Group(n, room, [(length, take(length, n * k), k) for length, k in used.items()]))
            todo -= n

    # What is left goes by decreasing length into the smallest room that holds it.
    by_room: dict[int, list[_Group]] = {}
    for group in groups:
        by_room.setdefault(group.room, []).append(group)
    rooms = sorted(by_room)

    def open_(group: _Group) -> None:
        if group.room not in by_room:
            by_room[group.room] = []
            bisect.insort(rooms, group.room)
        by_room[group.room].append(group)

    for length in reversed(lengths):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room = size
                group = _Group(-(-left[length] // (size // length)), size)
            per = min(room // length, left[length])
            n = min(group.count, left[length] // per)
            if n < group.count:  # the others keep their room
                rest = [(of, rank + n * k, k) for of, rank, k in group.runs]
                open_(_Group(group.count - n, room, rest))
            open_(_Group(n, room - length * per, [*group.runs, (length, take(length, n * per), per)]))
    rows, sequence = [], 0
    for group in (g for room in rooms for g in by_room[room]):
        if not group.runs:  # opened for the last documents of a length, which needed less
            continue
        offset = 0
        for length, rank, per in group.runs:
            rows.append((length, rank, per, sequence, offset))
            offset += length * per
        sequence += group.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _cut(vocabulary: bytes, size: int, end_id: int, with_ids: bool):
    """Pieces of the texts, each with its rank among those of its length that the task made."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        seen: dict[int, int] = {}
        for batch in batches:
            rows, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for r, data in enumerate(encoder.encode([t or b"" for t in as_bytes(batch.column(1))])):
                data += end
                for p, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    n = len(part) // 4
                    rows.append(r)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    nth.append(seen.get(n, 0))
                    seen[n] = nth[-1] + 1
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, nth)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "nth", "ids"][: len(columns)])

    return run


_encoders: dict[int, WordIds] = {}


def _encoder(vocabulary: bytes) -> WordIds:
    """One per worker process and vocabulary."""
    key = zlib.crc32(vocabulary)
    if key not in _encoders:
        _encoders[key] = WordIds(vocabulary)
    return _encoders[key]


def _place(rows: np.ndarray):
    """Looks the places up in the plan, which is sorted by length and rank."""
    keys = (rows[:, 0] << _LENGTH_SHIFT) | rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            _, first, per, sequence, offset = rows[np.searchsorted(keys, (length << _LENGTH_SHIFT) | rank, side="right") - 1].T
            place = rank - first
            out = batch.select([i for i, c in enumerate(batch.schema.names) if c != "rank"])
            out = out.append_column("sequence_id", pa.array(sequence + place // per))
            yield out.append_column("offset", pa.array(offset + place % per * length))

    return run


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    size: int = 4096, end_id: int = 1, with_ids: bool = False, classes: int = CLASSES,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids`` if asked for.

    A document is the ids that the tokenizer file ``vocabulary`` gives its text (null is empty; special strings inside count
    as the tokenizer takes them), then ``end_id``. Only documents of more than ``size`` ids are cut, into pieces of ``size``. Every
    row is a document, also if its id or text repeats; an empty table gives an empty result; other columns are not read.
    Pieces lie in sequences of at most ``size`` ids, from ``offset`` 0 on and without gaps.

    Texts are tokenized once and not shuffled. A piece's rank among those of its length is its rank in its task plus what earlier
    tasks have, from one row per task and length, so a length that all pieces share is no group of its own. The plan is made
    on the histogram of lengths, at most ``size`` numbers, and is sent to the tasks, which look up each piece's place: patterns of
    up to three documents, whose repeats a non-negative least squares fit gives, and for the rest best fit by decreasing length.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "nth")]
    fields = [source.schema["doc_id"], T.StructField("piece", T.IntegerType()), *longs]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    cut = source.mapInArrow(_cut(read_vocabulary(vocabulary), size, end_id, with_ids), T.StructType(fields))
    pieces = materialize(cut.withColumn("part", F.spark_partition_id()), "pack-pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before")).drop("nth", "before", "part")
    names = [f.name for f in fields if f.name != "nth"]
    out = [*[f for f in fields if f.name != "nth"], *[T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]]
    return ranked.select(*names, "rank").mapInArrow(_place(plan(histogram, size, classes)), T.StructType(out))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, lengths`` from the rows of ``pack(..., with_ids=True)``: at most ``size`` ids come together in one group."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(placed.alias("placed")).select(
        "sequence_id", F.flatten("placed.ids").alias("ids"), F.col("placed.doc_id").alias("doc_ids"), F.col("placed.length").alias("lengths"),
    )
