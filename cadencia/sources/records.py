"""CSV records whose quoted values may hold line breaks, read in parallel.

Spark reads such files in one task each, as a line break alone does not say whether a record ends. Here the lines of every byte range are
read by a task of their own. A range's quotes decide how it leaves the two states a line can begin in, outside or inside a quoted value;
these small functions are composed along each file, which gives the state every range begins in. Then each range puts
its records together, and what a record leaves in the ranges it crosses is joined at the end.
"""

from __future__ import annotations

import bisect
import csv
import io
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.session import materialize

#: Encodings in which quotes, separators and line feeds are the bytes they are in ASCII.
BYTEWISE = ("UTF-8", "ISO-8859-1", "US-ASCII")
#: Ranges that begin inside a quoted value, sent to the tasks at once; more files are read in two halves.
OPEN_RANGES = 200_000

_BOM = b"\xef\xbb\xbf"
# What an assembled row is: a record, a file's header, the beginning of a record that its range does not end, what a range adds to such a record.
_RECORD, _HEADER, _BEGUN, _HEADER_BEGUN, _MORE = range(5)

Ranges = dict[str, tuple[list[int], list[int]]]


def ends_quoted(line: bytes, sep: bytes, quoted: bool) -> bool:
    """Whether the line leaves a quoted value open, ``quoted`` telling whether it begins inside one.

    A value is quoted if its first character is a quote; two quotes inside are one. What follows the closing quote up to the separator is
    part of the value.
    """
    at = 0
    while True:
        if not quoted:
            if line[at : at + 1] != b'"':
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += 1
                continue
            at += 1
        while True:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] != b'"':
                break
            at += 2
        quoted = False
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The batch by path and range."""
    paths, starts = batch.column("path"), batch.column("start")
    at = 0
    while at < batch.num_rows:
        path, start = paths[at].as_py(), starts[at].as_py()
        # Ranges come one after the other, so the run ends where either changes.
        same = pc.and_(pc.equal(paths.slice(at), path), pc.equal(starts.slice(at), start))
        n = pc.index(same, False).as_py()
        n = batch.num_rows - at if n < 0 else n
        yield path, start, batch.slice(at, n)
        at += n


def _exits(sep: bytes):
    """For every range with quotes, whether it ends inside a quoted value if it begins outside, and if it begins inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, outside, inside, rows = None, False, True, []
        for batch in batches:
            for path, start, lines in _runs(batch):
                if (path, start) != key:
                    if key is not None:
                        rows.append((*key, outside, inside))
                    key, outside, inside = (path, start), False, True
                for line in lines.column("value").to_pylist():
                    if outside == inside:
                        outside = inside = ends_quoted(line, sep, outside)
                    else:
                        outside, inside = ends_quoted(line, sep, outside), ends_quoted(line, sep, inside)
        if key is not None:
            rows.append((*key, outside, inside))
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.bool_())],
            names=["path", "start", "outside", "inside"],
        )

    return run


def open_ranges(lines: DataFrame, sep: str) -> DataFrame:
    """``path, after, until``: ranges that begin after byte ``after`` and at or before ``until`` begin inside a quoted value."""
    quoted = lines.filter(F.col("text").contains('"')).select("value", "path", "start")
    exits = quoted.mapInArrow(_exits(sep.encode()), "path string, start long, outside boolean, inside boolean")
    exits = materialize(exits, "csv-exits")
    along = W.partitionBy("path").orderBy("start")
    swaps = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(along.rowsBetween(W.unboundedPreceding, 0))
    # Where both entries lead to one state, nothing before matters.
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("state"), "swaps"))
    counted = exits.withColumn("swaps", swaps).withColumn("fixed", F.last(fixed, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, 0)))
    state = (F.coalesce("fixed.state", F.lit(0)) + F.col("swaps") - F.coalesce("fixed.swaps", F.lit(0))) % 2
    until = F.coalesce(F.lead("start").over(along), F.lit((1 << 63) - 1))
    return counted.select("path", F.col("start").alias("after"), until.alias("until"), (state == 1).alias("open")).filter("open").drop("open")


def header_fields(header: bytes, sep: str, encoding: str) -> list[str]:
    text = header.removeprefix(_BOM).rstrip(b"\r").decode(encoding)
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=sep), [])


def column_names(fields: Sequence[str]) -> list[str]:
    """Names as Spark's reader gives them: a column without one is ``_c<position>``, names that differ in case only get their position."""
    lowered = [f.lower() for f in fields]
    return [f"_c{i}" if not f else f"{f}{i}" if lowered.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


def first_header(spark: SparkSession, path: str, sep: str) -> bytes:
    """The first record of a file. An action, on its first lines."""
    n = 1
    while True:
        lines = [bytes(r.value) for r in spark.read.text(path, lineSep="\n").select(F.col("value").cast("binary")).head(n)]
        quoted = False
        for i, line in enumerate(lines):
            quoted = ends_quoted(line, sep.encode(), quoted)
            if not quoted:
                return b"\n".join(lines[: i + 1])
        if len(lines) < n:
            return b"\n".join(lines)
        n *= 4


def _assemble(sep: bytes, opened: Ranges, same_header, width: int):
    """Rows of lines to rows of records; ``width`` further columns are those of a record's first line in the range."""

    class Block:
        def __init__(self, path: str, start: int):
            after, until = opened.get(path, ((), ()))
            i = bisect.bisect_left(after, start) - 1
            self.path, self.start = path, start
            self.quoted = self.more = i >= 0 and start <= until[i]
            self.first = start == 0 and not self.quoted
            self.held: list[bytes] = []
            self.row: pa.RecordBatch | None = None

        def hold(self, lines: pa.RecordBatch) -> None:
            if self.row is None:
                self.row = lines.slice(0, 1)
            self.held += lines.column("value").to_pylist()

        def release(self, ended: bool) -> Iterator[pa.RecordBatch]:
            if self.row is not None:
                kind = _MORE if self.more else (_HEADER if self.first else _RECORD) if ended else (_HEADER_BEGUN if self.first else _BEGUN)
                yield from self.emit(pa.array([b"\n".join(self.held)], pa.binary()), self.row, kind)
            self.held, self.row, self.more = [], None, False

        def emit(self, values: pa.Array, rows: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
            if kind == _HEADER:
                self.check_header(values[0].as_py())
                return
            if kind == _HEADER_BEGUN:
                self.first = False
            if len(values):
                columns = [rows.column(i) for i in range(1, rows.num_columns)]
                yield pa.RecordBatch.from_arrays([values, *columns, pa.array(np.full(len(values), kind, np.int32))], names=[*rows.schema.names, "kind"])

        def check_header(self, header: bytes) -> None:
            if same_header is not None and not same_header(header):
                raise ValueError(f"the header of {self.path} differs from the first file's: {header!r}")
            self.first = False

        def add(self, lines: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            values = lines.column("value")
            marked = pc.indices_nonzero(pc.match_substring(values, '"'))
            single = np.ones(lines.num_rows, bool)
            at: list[int] = []
            joined: list[bytes] = []
            begin = 0
            for i, line in zip(marked.to_pylist(), values.take(marked).to_pylist()):
                was, self.quoted = self.quoted, ends_quoted(line, sep, self.quoted)
                if self.quoted and not was:
                    begin = i
                elif was and not self.quoted:
                    single[begin : i + 1] = False
                    if self.more or self.row is not None:  # begun in an earlier range or batch
                        self.hold(lines.slice(begin, i + 1 - begin))
                        yield from self.release(True)
                    else:
                        at.append(begin)
                        joined.append(b"\n".join(values.slice(begin, i + 1 - begin).to_pylist()))
            if self.quoted:
                single[begin:] = False
            if self.first and single[0]:
                self.check_header(values[0].as_py())
                single[0] = False
            elif self.first and at and at[0] == 0:
                self.check_header(joined.pop(0))
                at.pop(0)
            whole = lines if single.all() else lines.filter(pa.array(single))
            yield from self.emit(whole.column("value"), whole, _RECORD)
            if joined:
                yield from self.emit(pa.array(joined, pa.binary()), lines.take(pa.array(at, pa.int64())), _RECORD)
            if self.quoted:
                self.hold(lines.slice(begin))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        for batch in batches:
            for path, start, lines in _runs(batch):
                if block is None or (block.path, block.start) != (path, start):
                    if block is not None:
                        yield from block.release(False)
                    block = Block(path, start)
                yield from block.add(lines)
        if block is not None:
            yield from block.release(False)

    return run


def read_records(
    spark: SparkSession, paths: str | Sequence[str], sep: str, origin: Mapping[str, Column] | None = None,
    header: bytes | None = None, encoding: str = "UTF-8", max_ranges: int = OPEN_RANGES,
) -> DataFrame:
    """``record`` (binary) and the ``origin`` columns for every record of the files but their headers; blank ones are left out.

    Lines end with a line feed, before which a carriage return is dropped; a quoted value keeps both. With ``header`` the first
    record of every file must name the same columns, or the read fails. An action, which reads the lines that hold quotes.
    """
    origin = origin or {}
    raw = spark.read.text([paths] if isinstance(paths, str) else list(paths), lineSep="\n")
    own = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    lines = raw.select(F.col("value").cast("binary").alias("value"), *own, *[c.alias(n) for n, c in origin.items()], F.col("value").alias("text"))
    ranges = open_ranges(lines, sep)
    files = sorted(raw.inputFiles())
    found = ranges.limit(max_ranges + 1).collect()
    if len(found) > max_ranges and len(files) > 1:
        halves = [read_records(spark, part, sep, origin, header, encoding, max_ranges) for part in (files[: len(files) // 2], files[len(files) // 2 :])]
        return halves[0].unionByName(halves[1])
    if len(found) > max_ranges:  # of one file, which has no more of them than byte ranges
        found = ranges.collect()
    opened: Ranges = {}
    for path, after, until in sorted((r.path, r.after, r.until) for r in found):
        opened.setdefault(path, ([], []))[0].append(after)
        opened[path][1].append(until)
    fields = None if header is None else header_fields(header, sep, encoding)
    same = None if fields is None else lambda other: header_fields(other, sep, encoding) == fields
    narrow = lines.drop("text")
    assembled = narrow.mapInArrow(
        _assemble(sep.encode(), opened, same, len(origin)), T.StructType([*narrow.schema.fields, T.StructField("kind", T.IntegerType())]),
    )
    whole = assembled.filter(F.col("kind") == _RECORD).select("value", *origin)
    if opened:
        whole = whole.unionByName(_joined(assembled.filter(F.col("kind").isin(_BEGUN, _HEADER_BEGUN, _MORE)), list(origin)))
    record = F.expr("CASE WHEN right(value, 1) = X'0D' THEN substring(value, 1, octet_length(value) - 1) ELSE value END")
    return whole.select(record.alias("record"), *origin).filter(F.octet_length("record") > 0)


def _joined(parts: DataFrame, origin: list[str]) -> DataFrame:
    """Records that cross ranges: what each range has of one, in order. A record's parts are its own size, so a group is one record."""
    parts = materialize(parts, "csv-parts")
    # In one range what ends a record comes before what begins the next.
    order = W.partitionBy("path").orderBy("start", (F.col("kind") != _MORE).cast("int"))
    begun = F.when(F.col("kind") != _MORE, F.struct("start", "kind"))
    owned = parts.withColumn("of", F.last(begun, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    pieces = F.sort_array(F.collect_list(F.struct("start", (F.col("kind") == _MORE).alias("later"), "value")))
    of_first = [F.min_by(c, F.struct("start", (F.col("kind") == _MORE).cast("int"))).alias(c) for c in origin]
    grouped = owned.filter(F.col("of.kind") == _BEGUN).groupBy("path", F.col("of.start").alias("begin")).agg(pieces.alias("pieces"), *of_first)
    text = F.aggregate(
        F.slice("pieces.value", 2, F.size("pieces")), F.get("pieces.value", F.lit(0)), lambda done, piece: F.concat(done, F.lit(b"\n"), piece),
    )
    return grouped.select(text.alias("value"), *origin)


def decoded(record: Column, encoding: str) -> Column:
    """Bytes as text; bytes that are not of the encoding become U+FFFD, as in Spark's own reader."""
    if encoding.upper() == "UTF-8":
        return F.make_valid_utf8(record.cast("string"))
    return F.decode(record, encoding)
