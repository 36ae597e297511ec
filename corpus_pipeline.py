"""From raw documents to balanced shards: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.llm.common import table, text_key
from cadencia.llm.decontam import decontaminate
from cadencia.llm.mixing import mix
from cadencia.llm.quality import scorer, train
from cadencia.llm.sharding import shard
from cadencia.llm.simhash import near_dedup
from cadencia.session import materialize

# A row is known by its id, the key of its text and a hash of its other columns: ids may be null or shared, and what
# is decided about one row must not reach another. Rows that agree in all three are equal and interchangeable.
_KEY = ("doc_id", "_tk", "_rest")


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with the other two parts of their key."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.xxhash64(F.col("text").isNull(), *[x for c in others for x in (F.col(c), F.col(c).isNull())])
    return docs.withColumns({"_tk": text_key(F.col("text")), "_rest": rest})


def _joined(docs: DataFrame, found: DataFrame, key: tuple[str, ...], how: str) -> DataFrame:
    """``docs`` joined on ``key``, null ids being equal; the key columns of ``found`` go."""
    named = found.select(*[F.col(c).alias(f"_of{c}") if c in key else F.col(c) for c in found.columns])
    same = docs["doc_id"].eqNullSafe(named["_ofdoc_id"])
    for c in key[1:]:
        same &= docs[c] == named[f"_of{c}"]
    return docs.join(named, same, how).drop(*[f"_of{c}" for c in key])


def _once(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One of the equal rows of each key in ``repeated``, all other rows."""
    one = _joined(docs, repeated, _KEY, "left_semi").dropDuplicates(list(_KEY))
    return _joined(docs, repeated, _KEY, "left_anti").unionByName(one)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on ``labels``, rejects: a score under 0.3."""
    chance = scorer(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.filter(chance(F.col("text")) >= 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash component, that of the smallest id, null ids before all; of rows that share it, the smallest key's."""
    keyed = _keyed(docs)
    placed = materialize(near_dedup(keyed.withColumn("_key", F.struct(*_KEY)), "_key"), "pipeline-near")
    key = [F.col(f"doc_id.{c}").alias(c) for c in _KEY]
    gone = materialize(placed.filter("doc_id <> component_id").select(*key).distinct(), "pipeline-near-gone")
    repeated = placed.filter("doc_id = component_id").select(*key).groupBy(*_KEY).count().filter("count > 1").drop("count")
    return _once(_joined(keyed, gone, _KEY, "left_anti"), materialize(repeated, "pipeline-repeated")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the decontamination contract calls contaminated."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), with_key=True).withColumnRenamed("tk", "_tk")
    gone = materialize(found.filter("contaminated").select("doc_id", "_tk").distinct(), "pipeline-contaminated")
    return _joined(_keyed(docs), gone, ("doc_id", "_tk"), "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, from none to three times; equal rows as often as all of them together."""
    keyed = _keyed(docs)
    copies = mix(keyed, carry=_KEY[1:]).groupBy(*_KEY).agg(F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = materialize(copies, "pipeline-copies")
    distinct = _once(keyed, copies.filter("_rows > 1").select(*_KEY))
    return (
        _joined(distinct, copies.filter("_copies > 0").drop("_rows"), _KEY, "inner")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*docs.columns)
    )


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with all its columns, and its place in one of sixteen shards of near-equal bytes.

    Null and empty texts are rows like others, rows that are equal stay together and are numbered in either order, and an
    empty table gives no rows. A column named like one of those added (``size``, ``shard``, ...) is called ``document_<name>``.
    """
    return shard(docs, shards=16, whole=True)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

#: SQL cannot express the first stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-stage{number}")
    return docs
