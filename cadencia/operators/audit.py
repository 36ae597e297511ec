"""Comparison of two tables as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadencia.operators.prints import compare_groups, fingerprint, row_prints
from cadencia.session import materialize

LEFT, RIGHT = "1_left", "2_right"


class SchemaVerdict(NamedTuple):
    same: bool
    messages: list[str]


def compare_schemas(left: StructType, right: StructType, strict_order: bool = False) -> SchemaVerdict:
    """Columns on one side only and differing types fail; a differing order only if ``strict_order``."""
    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (left, right))
    faults = [f"only left: {c}" for c in sorted(a.keys() - b.keys())]
    faults += [f"only right: {c}" for c in sorted(b.keys() - a.keys())]
    faults += [f"{c}: {a[c]} against {b[c]}" for c in sorted(a.keys() & b.keys()) if a[c] != b[c]]
    reordered = not faults and list(a) != list(b)
    notes = ["column order differs"] if reordered else []
    return SchemaVerdict(not faults and not (reordered and strict_order), faults + notes)


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 (16 bytes) of the row as JSON: columns by name, nulls written out."""
    ordered = F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])
    text = F.to_json(ordered, {"ignoreNullFields": "false"})
    # Never null, and declared so: otherwise a join on it computes it once more to drop nulls.
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(bytearray()))


def paired_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Copies of each row hash on both sides, 0 where a side lacks it.

    Stands for a full outer join of two grouped tables: both sides go into one aggregation, which
    counts before the shuffle and sends one short row per distinct hash.
    """
    h = row_hash(left.columns).alias("h")
    tagged = left.select(h, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(h, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.groupBy("h").agg(
        F.sum("l").alias("left_count"), F.sum("r").alias("right_count")
    )


def multiset_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: matched rows, rows only on one side, totals. Five zeros for two empty tables."""
    l, r = F.col("left_count"), F.col("right_count")

    def total(expr: Column) -> Column:
        return F.coalesce(F.sum(expr), F.lit(0)).cast("bigint")

    return paired_counts(left, right).agg(
        total(F.least(l, r)).alias("matched_rows"),
        total(F.greatest(l - r, F.lit(0))).alias("only_left_rows"),
        total(F.greatest(r - l, F.lit(0))).alias("only_right_rows"),
        total(l).alias("left_total"),
        total(r).alias("right_total"),
    )


#: Parts of a table that has no date: rows are dealt out by their hash.
_BUCKETS = 1024
_PART = "_part"


class Narrowed(NamedTuple):
    """What fingerprints leave to be compared row by row."""

    left: DataFrame
    right: DataFrame
    equal_rows: int
    parts: int
    differing_parts: int


def _narrow(left: DataFrame, right: DataFrame, column: str | None) -> tuple[Narrowed, int, int]:
    """The narrowed sides, and the number of rows of both whole ones."""

    def parted(df: DataFrame) -> DataFrame:
        bucket = F.pmod(row_prints(df, df.columns)[0], F.lit(_BUCKETS))
        return df.withColumn(_PART, F.col(f"`{column}`").cast("date") if column else bucket)

    sides = [parted(df) for df in (left, right)]
    prints = [fingerprint(df, [_PART], left.columns) for df in sides]
    parts = materialize(compare_groups(*prints, [_PART]), "audit-parts")
    total = parts.agg(
        F.sum(F.when(F.col("same"), F.col("left_rows")).otherwise(0)), F.count("*"), F.count_if(~F.col("same")),
        F.sum("left_rows"), F.sum("right_rows"),
    ).first()
    names = [f"`{c}`" for c in left.columns]
    if total[1] == total[2]:  # nothing is left out, so no row needs its part again
        kept = [df.select(*names) for df in (left, right)]
    else:
        differing = parts.filter("NOT same").select(F.col(_PART).alias("_differing"))
        kept = [df.join(differing, df[_PART].eqNullSafe(differing["_differing"]), "left_semi").select(*names) for df in sides]
    return Narrowed(*kept, total[0] or 0, total[1], total[2]), total[3] or 0, total[4] or 0


def narrowed(left: DataFrame, right: DataFrame, column: str | None = None) -> Narrowed:
    """Both sides without the days of ``column`` (without one: hash buckets) that hold equal multisets of rows. An action.

    Each side is scanned once; a task sends one fingerprint per part. Equal rows lie in one part, so what the parts that
    are left have more of is what the tables have more of. Rows without a date are a part.
    """
    return _narrow(left, right, column)[0]


def narrowed_report(left: DataFrame, right: DataFrame, column: str | None = None) -> tuple[dict[str, int], DataFrame | None]:
    """The summary of the two tables and all discrepancies, written (None: no part differs). An action.

    A row that is not in the report has as many copies on either side, so the report and the numbers of rows give the summary.
    """
    found, left_rows, right_rows = _narrow(left, right, column)
    rows, only_left, only_right = None, 0, 0
    if found.differing_parts:
        rows = materialize(discrepancies(found.left, found.right), "audit-rows")
        counted = multiset_summary(*[rows.filter(F.col("side") == side).drop("side") for side in (LEFT, RIGHT)]).first()
        only_left, only_right = counted["only_left_rows"], counted["only_right_rows"]
    summary = {"matched_rows": left_rows - only_left, "only_left_rows": only_left, "only_right_rows": only_right, "left_total": left_rows, "right_total": right_rows}
    return summary, rows


def narrowed_summary(parts: Narrowed) -> dict[str, int]:
    """The summary of the two tables, from the parts that differ and the number of rows in the others. An action."""
    equal = dict.fromkeys(("matched_rows", "left_total", "right_total"), parts.equal_rows)
    found = multiset_summary(parts.left, parts.right).first().asDict() if parts.differing_parts else {}
    names = ("matched_rows", "only_left_rows", "only_right_rows", "left_total", "right_total")
    return {n: found.get(n, 0) + equal.get(n, 0) for n in names}


#: Suspects' hashes are marked in a bitmap of 2^28 bits (32 MB), which goes to every task: 2^16 rows of 64 words.
_WORD_BITS, _ROW_BITS, _MAP_BITS = 6, 12, 28


def _suspect_hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row hashes ``x`` whose rows do not cancel out: copies on the left count up, those on the right down, and so does a second
    hash in two pieces of 31 bits. All differing rows have one, but for a chance of the kind a fingerprint takes; one that two rows share may be of equal rows too."""

    def signed(df: DataFrame, sign: int) -> DataFrame:
        x, y = row_prints(df, df.columns)
        pieces = [F.shiftrightunsigned(y, at).bitwiseAND(F.lit((1 << 31) - 1)) * sign for at in (0, 33)]
        return df.select(x.alias("x"), F.lit(sign).cast("bigint").alias("n"), *[p.alias(f"y{i}") for i, p in enumerate(pieces)])

    sums = signed(left, 1).unionAll(signed(right, -1)).groupBy("x").agg(*[F.sum(c).alias(c) for c in ("n", "y0", "y1")])
    return sums.filter("n <> 0 OR y0 <> 0 OR y1 <> 0").select("x")


def _place(x: Column) -> tuple[Column, Column, Column]:
    """Bitmap row, word in the row and bit in the word of a hash."""
    part = lambda low, high: F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).cast("int")
    return part(_ROW_BITS, _MAP_BITS), part(_WORD_BITS, _ROW_BITS), part(0, _WORD_BITS)


def _bitmap(hashes: DataFrame) -> DataFrame:
    """The places of hashes ``x``, as rows ``at, words``."""
    at, word, bit = _place(F.col("x"))
    set_bits = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = hashes.groupBy(at.alias("at"), word.alias("word")).agg(F.bit_or(set_bits).alias("bits"))
    listed = words.groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    every = F.sequence(F.lit(0), F.lit((1 << (_ROW_BITS - _WORD_BITS)) - 1))
    return listed.select("at", F.transform(every, lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("bigint"))).alias("words"))


def discrepancies(left: DataFrame, right: DataFrame, limit: int | None = None) -> DataFrame:
    """All copies of every row whose count differs, side column first; all of them unless a ``limit`` is named.

    With a limit the rows are the first in order of all columns and side. Only hashes of all rows are shuffled. The rows
    themselves are looked up in a bitmap of the suspects' hashes where they are scanned; what is found there is joined with the hashes,
    written, and its copies are counted by ``row_hash``. So a shuffle of rows is as large as the report and what the bitmap
    lets through by accident, 4 % of the rows at ten million suspects.
    """
    columns = sorted(left.columns)
    hashes = materialize(_suspect_hashes(left, right.select(*[f"`{c}`" for c in left.columns])), "audit-suspect-hashes")
    bitmap = F.broadcast(materialize(_bitmap(hashes), "audit-bitmap"))
    at, word, bit = _place(F.col("_x"))
    marked = (at == F.col("at")) & (F.getbit(F.get("words", word), bit) == 1)
    sides = [
        df.select(F.lit(side).alias("side"), *[f"`{c}`" for c in columns], row_prints(df, columns)[0].alias("_x"))
        .join(bitmap, marked, "left_semi")
        .withColumn("_h", row_hash(columns))
        for df, side in ((left, LEFT), (right, RIGHT))
    ]
    suspects = materialize(
        sides[0].unionAll(sides[1]).join(hashes, F.col("_x") == hashes["x"], "left_semi").drop("_x"), "audit-suspects",
    )
    # Hashes that rows share by chance, or values that only hash differently: seldom any.
    balanced = materialize(
        suspects.groupBy("_h").agg(F.sum(F.when(F.col("side") == LEFT, 1).otherwise(-1)).alias("n")).filter("n = 0").select("_h"),
        "audit-balanced",
    )
    rows = suspects.join(balanced, "_h", "left_anti").drop("_h")
    return rows if limit is None else rows.orderBy(*[f"`{c}`" for c in columns], "side").limit(limit)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """What each side has more of, by a check without hashes; ``side`` first."""
    ordered = right.select(*[f"`{c}`" for c in left.columns])
    only_left, only_right = left.exceptAll(ordered), ordered.exceptAll(left)
    return only_left.select(F.lit(LEFT).alias("side"), "*").unionAll(only_right.select(F.lit(RIGHT).alias("side"), "*"))


def multisets_equal(left: DataFrame, right: DataFrame) -> bool:
    """Independent check without hashes. An action."""
    return multiset_difference(left, right).isEmpty()


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: non-null values per column; compare before and after a load."""
    return df.agg(*[F.count(f"`{c}`").alias(c) for c in columns])


def roundtrip_faults(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> list[str]:
    """Critical columns that are missing or whose non-null counts differ. An action."""
    faults = [f"{c}: missing" for c in columns if c not in before.columns or c not in after.columns]
    present = [c for c in columns if c in before.columns and c in after.columns]
    if present:
        a, b = (non_null_counts(df, present).first() for df in (before, after))
        faults += [f"{c}: {a[c]} against {b[c]}" for c in present if a[c] != b[c]]
    return faults
