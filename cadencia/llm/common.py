"""What the operators share: table access, Arrow batches, running totals."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Bytes (and code points) that count as whitespace in the contracts.
BLANKS = b" \t\n\x0b\x0c\r"

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, everything else untouched (``lower`` alone would change other scripts)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share an id; a null text is as an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(text))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def bounded_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of at most 8 MB, unless the session has set a bound of its own."""
    if spark.conf.get(_BATCH_BYTES) == "67108864b":  # Spark's default
        spark.conf.set(_BATCH_BYTES, "8m")


def ordered_parts(df: DataFrame, *order: Column) -> DataFrame:
    """Range-partitioned and sorted by ``order``, with the partition number in ``part``.

    Write the result before using it twice: range bounds come from a sample and may move when recomputed.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def running_totals(parts: DataFrame, order: list[Column], **values: Column) -> DataFrame:
    """For each name a column with the total of its values over all rows before this one, in global order.

    ``parts`` is a written ``ordered_parts`` frame. A partition's rows are summed within it; what precedes the
    partition comes from one row per partition, so no task sees more than its own range.
    """
    totals = parts.groupBy("part").agg(*[F.sum(v).alias(f"_all_{n}") for n, v in values.items()])
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in values])
    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = parts.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{n}") for n, v in values.items()])
    return within.join(offsets, "part").select(
        *[within[c] for c in parts.columns], *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in values]
    )
