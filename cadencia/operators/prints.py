"""Additive fingerprints of groups of rows.

The fingerprint of a multiset is its number of rows and the sums of their hashes, so it needs no order, is combined before the
shuffle, and the fingerprints of parts add up to that of the whole. Equal multisets have equal fingerprints; different ones
differ but for a chance of about one in 2^128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A hash is summed in pieces of this many bits: a piece's sum holds 2^41 rows.
_PIECE_BITS, _PIECES = 22, 3
_SEEDS = (1, 2)

COUNT = "n_rows"
PRINTS = tuple(f"print{seed}_{piece}" for seed in _SEEDS for piece in range(_PIECES))


def _plain(field: T.StructField) -> list[Column]:
    """The column as something that hashes alike only where the values are the same: -0.0 is not 0.0, and any type has a hash."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return [col, F.when(col == 0, col.cast("string"))]  # only zeros need their text
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return [F.to_json(F.struct(col), {"ignoreNullFields": "false"})]
    return [col]


def row_prints(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the row, one per seed, over ``columns`` in order of their names."""
    fields = [df.schema[c] for c in sorted(columns)]
    # A null leaves a hash as it is; the row of which columns are null tells (null, 'a') from ('a', null).
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{f.name}`").isNull(), "n").otherwise("v") for f in fields])
    return [F.xxhash64(F.lit(seed), nulls, *[p for f in fields for p in _plain(f)]) for seed in _SEEDS]


def fingerprint(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Number and fingerprint of the rows of each group ``by``, over ``columns`` (default: all), null groups included.

    The columns are taken in order of their names, so frames whose columns stand in another order agree.
    """
    hashes = row_prints(df, df.columns if columns is None else columns)
    hashed = df.select(*[F.col(f"`{c}`") for c in by], *[h.alias(f"_h{seed}") for seed, h in zip(_SEEDS, hashes)])
    mask = (1 << _PIECE_BITS) - 1
    sums = [
        F.sum(F.shiftrightunsigned(f"_h{seed}", piece * _PIECE_BITS).bitwiseAND(F.lit(mask))).alias(f"print{seed}_{piece}")
        for seed in _SEEDS for piece in range(_PIECES)
    ]
    return hashed.groupBy(*[f"`{c}`" for c in by]).agg(F.count(F.lit(1)).alias(COUNT), *sums)


def compare_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two frames of fingerprints side by side: per group ``left_rows, right_rows, same``. One aggregation over both, no join."""
    values = [COUNT, *PRINTS]
    both = left.select(*by, *values, F.lit(0).alias("_side")).unionByName(right.select(*by, *values, F.lit(1).alias("_side")))
    same = F.count(F.lit(1)) == 2
    for v in values:
        same &= F.min(v) == F.max(v)
    rows = [F.sum(F.when(F.col("_side") == n, F.col(COUNT)).otherwise(0)).alias(name) for n, name in enumerate(("left_rows", "right_rows"))]
    return both.groupBy(*by).agg(*rows, same.alias("same"))


def changed_groups(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose fingerprints differ or that only one side has, each once."""
    return compare_groups(before, after, by).filter("NOT same").select(*by)
