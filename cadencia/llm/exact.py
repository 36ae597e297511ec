"""Exact duplicates by two passes over Bloom filters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm import bloom
from cadencia.llm.common import BLANKS, as_bytes, bounded_batches
from cadencia.session import materialize


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in as_bytes(batch.column(1))]
        sums = [hashlib.sha256(t.translate(None, BLANKS)).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sums, pa.binary()), batch.column(2)], names=["doc_id", "sha", "n_chars"],
        )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if identical without ``[\\x20\\x09-\\x0D]``; null counts as empty. The row with the most code
    points of the original text stays, then the smallest id (null before all), then one of the rows that repeat
    an id and text, so exactly one row of a group is ``kept``. An empty table gives an empty result; other columns
    are not read.

    The first pass digests the texts into a narrow table and fills the filters from it. In the second, only rows
    whose digest the ``twice`` filter knows are shuffled and grouped exactly (counts and the best row combine before
    the shuffle); all others pass through as groups of one. Texts are never shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_chars"),
    )
    schema = T.StructType([source.schema["doc_id"], T.StructField("sha", T.BinaryType()), T.StructField("n_chars", T.LongType())])
    narrow = materialize(
        source.mapInArrow(_digests, schema)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("h", F.xxhash64("sha")),
        "exact-digests",
    )
    twice = spark.sparkContext.broadcast(bloom.twice_filter(narrow.select("h"), bloom.bits_for(narrow.count(), max_bits)))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.append_column("suspect", pa.array(bloom.contains(twice.value, h)))

    flagged = narrow.mapInArrow(flag, T.StructType([*narrow.schema.fields, T.StructField("suspect", T.BooleanType())]))
    suspects = flagged.filter("suspect")
    # Written, so that the join below has its own exchanges and a hot digest can be split there.
    groups = materialize(
        suspects.groupBy("sha").agg(
            F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").alias("id"), "row")).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "exact-groups",
    )
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    repeated = suspects.join(groups, "sha").select(
        "doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), digest,
    )
    single = flagged.filter("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest,
    )
    return repeated.unionByName(single)
