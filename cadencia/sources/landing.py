"""Landing of reports that are kept as they come: text columns plus where they came from.

A file is known by its path, modification time and size. A file that changed is landed again, as a new version. Rows
are stored under a batch, and a batch counts once it is in the ledger, a small table of the files landed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.sources.reports import list_files, read_text_columns

ORIGIN = ("source_file", "source_path", "source_modified", "batch", "window_start")
_LEDGER = "source_path string, source_modified timestamp, bytes bigint, batch string"


def ledger(spark: SparkSession, target: str, report: str) -> DataFrame:
    path = f"{target}/ledger/report={report}"
    if list_files(spark, f"{path}/*.parquet").isEmpty():
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def _files(spark: SparkSession, paths: str | Sequence[str]) -> list:
    """The non-empty files asked for, as a list on the driver: it is no longer than the caller's request."""
    return list_files(spark, paths).orderBy("path").collect()


def land_report(
    spark: SparkSession, paths: str | Sequence[str], report: str, window_start: str, target: str,
    sep: str = ";", encoding: str = "ISO-8859-1", line_breaks: bool = True,
) -> list[str]:
    """Append every file, or version of a file, that has not been landed for this report; returns their names.

    Files of one name in different folders are different files. Columns without a header are kept.
    """
    files = _files(spark, paths)
    if not files:
        raise FileNotFoundError(f"no file at {paths}")
    entries = spark.createDataFrame([(f.location, f.modified, f.bytes) for f in files], "source_path string, source_modified timestamp, bytes bigint")
    keys = ["source_path", "source_modified", "bytes"]
    known = {tuple(r) for r in entries.join(ledger(spark, target, report), keys, "left_semi").collect()}
    fresh = [f for f in files if (f.location, f.modified, f.bytes) not in known]
    if not fresh:
        return []
    batch = uuid.uuid4().hex
    origin = {
        "source_file": F.col("_metadata.file_name"), "source_path": F.col("_metadata.file_path"),
        "source_modified": F.col("_metadata.file_modification_time"), "window_start": F.lit(window_start).cast("date"),
    }
    df = read_text_columns(
        spark, [f.path for f in fresh], sep, encoding, line_breaks=line_breaks, unnamed=True, origin=origin,
    )
    df.write.parquet(f"{target}/report={report}/batch={batch}")
    rows = spark.createDataFrame([(f.location, f.modified, f.bytes, batch) for f in fresh], _LEDGER)
    rows.coalesce(1).write.mode("append").parquet(f"{target}/ledger/report={report}")
    return [f.name for f in fresh]


def landed(
    spark: SparkSession, target: str, report: str, versions: str = "newest", paths: str | Sequence[str] | None = None,
) -> DataFrame:
    """Landed rows: the newest version of every file or ``all``; ``paths`` limits them to the files that are there now."""
    if versions not in ("newest", "all"):
        raise ValueError(f"versions must be 'newest' or 'all', not {versions!r}")
    known = ledger(spark, target, report).select("source_path", "source_modified", "batch")
    if versions == "newest":
        newest = known.groupBy("source_path").agg(F.max("source_modified").alias("source_modified"))
        known = known.join(newest, ["source_path", "source_modified"], "left_semi")
    if paths is not None:
        there = [(f.location, f.modified) for f in _files(spark, paths)]
        known = known.join(spark.createDataFrame(there, "source_path string, source_modified timestamp"), ["source_path", "source_modified"], "left_semi")
    rows = spark.read.option("mergeSchema", "true").parquet(f"{target}/report={report}")
    return rows.join(known, ["source_path", "source_modified", "batch"], "left_semi")
