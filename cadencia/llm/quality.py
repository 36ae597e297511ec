"""Quality classifier: hashed word n-grams, logistic regression trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import bounded_batches
from cadencia.session import materialize

BUCKETS = 1 << 18
BIAS = BUCKETS
#: Runs of letters and digits, or of other visible characters.
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_CACHE_ENTRIES = 1 << 18
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Features are shares of a text's tokens; this brings them to the order of one.
_SCALE = 16.0


class _Codes(dict):
    """Token to 64 bits: hash of the lowered word above, hash of its look (case, digits, or the sign itself) below."""

    def __missing__(self, token: str) -> int:
        if token[0].isalnum():
            look = 1 if token.isdigit() else 2 if len(token) > 1 and token.isupper() else 3 if token[0].isupper() else 4
        else:
            look = 8 + (zlib.crc32((token[0] + "+" * min(len(token) - 1, 2)).encode()) >> 1)
        code = (zlib.crc32(token.lower().encode()) << 32) | look
        if len(self) < _CACHE_ENTRIES:
            self[token] = code
        return code


class Featurizer:
    """Bucket numbers of a text's word n-grams: words and pairs of words, and looks in runs of one to three.

    A word equal to the one before has a look of its own, so that repetition is an n-gram too.
    """

    def __init__(self) -> None:
        self.codes = _Codes()

    def __call__(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text)
        if not tokens:
            return np.zeros(0, np.int64)
        codes = np.fromiter(map(self.codes.__getitem__, tokens), np.uint64, len(tokens))
        word, look = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
        look[1:][word[1:] == word[:-1]] = 5
        with np.errstate(over="ignore"):
            grams = [
                word * _MIX[0] + np.uint64(1),
                (word[:-1] * _MIX[0]) ^ (word[1:] * _MIX[1] + np.uint64(2)),
                look * _MIX[1] + np.uint64(3),
                (look[:-1] * _MIX[1]) ^ (look[1:] * _MIX[2] + np.uint64(4)),
                (look[:-2] * _MIX[1]) ^ (look[1:-1] * _MIX[2]) ^ (look[2:] * _MIX[0] + np.uint64(5)),
            ]
            h = np.concatenate(grams)
            h = (h ^ (h >> np.uint64(31))) * _MIX[2]
        return (h >> np.uint64(46)).astype(np.int64)


def _train_shard(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-Proximal over a shard's rows in their order."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for label, i, x in rows:
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(BUCKETS + 1))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: CRC-32 of the id as text divisible by 5 (a null id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_rows: int = 20_000, shards: int = 8, epochs: int = 8,
    alpha: float = 1.0, beta: float = 0.5, l1: float = 0.02, l2: float = 0.1,
) -> np.ndarray:
    """Weights of all buckets, the bias last.

    Learns from at most ``max_rows`` labelled rows that are not held out, those with the smallest hash of their id: a
    documented bound, so training costs the same at any size. Whole texts are used. Rows are dealt to
    ``shards`` tasks by hash, each makes ``epochs`` passes, and their weights are averaged. Several labels of one id
    count as their mean; null labels are no labels. Without labels all weights are 0 and every score is 0.5.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    chosen = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
        .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows)
    )
    chosen = materialize(chosen, "quality-labels")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer()
        for batch in batches:
            buckets, values = [], []
            for text in batch.column(2):
                found = make(text.as_py() or "")
                i, c = np.unique(found, return_counts=True)
                buckets.append(np.append(i, BIAS).astype(np.int32))
                values.append(np.append(c * (_SCALE / max(len(found), 1)), 1.0).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["h", "label", "buckets", "values"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for shard, label, i, x in zip(batch.column("shard").to_pylist(), batch.column("label").to_pylist(), batch.column("buckets"), batch.column("values")):
                held.setdefault(shard, []).append(
                    (label, i.values.to_numpy(), x.values.to_numpy().astype(np.float64)),
                )
        for rows in held.values():
            w = _train_shard(rows, epochs, alpha, beta, l1, l2)
            i = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(w[i])], names=["bucket", "w"])

    # At most `max_rows` short rows: a proven bound.
    sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = sample.select("h", "label", "text").mapInArrow(features, "h long, label double, buckets array<int>, values array<float>")
    dealt = rows.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).repartition(shards, "shard").sortWithinPartitions("shard", "h", "label")
    # Rounded, so that the order in which shards are added does not show.
    mean = dealt.mapInArrow(learn, "bucket int, w double").groupBy("bucket").agg(F.round(F.sum("w") / shards, 7).alias("w"))
    weights = np.zeros(BUCKETS + 1)
    for row in mean.collect():  # at most BUCKETS + 1 rows
        weights[row.bucket] = row.w
    return weights


def scorer(spark: SparkSession, weights: np.ndarray):
    """A function of a text column: the chance of label 1. Null, empty and tokenless texts score by the bias alone."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make, w = Featurizer(), shared.value
        for texts in batches:
            dots = np.zeros(len(texts))
            for r, text in enumerate(texts):
                found = make(text or "")
                if len(found):
                    dots[r] = w[found].mean() * _SCALE
            yield pd.Series(1 / (1 + np.exp(-np.clip(dots + w[BIAS], -30, 30))))

    return run


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``; only the text is scored.

    A score is the sparse dot product of the weights with the text's n-gram shares, through the logistic function.
    Repeated rows score alike; an empty table gives an empty result. Other columns are not read.
    """
    scored = docs.select(F.col(id_col).alias("doc_id"), scorer(docs.sparkSession, weights)(F.col(text_col)).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
