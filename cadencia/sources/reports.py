"""Readers for the raw reports: everything as text, columns found by header name."""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.functions.text import null_if_na, without_bom
from cadencia.sources import records

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("location", T.StringType()),
    ]
)


def _files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame | None:
    try:
        return spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Path, name, modification time, size and location (as row metadata gives it) of a glob's non-empty files, contents unread."""
    files = _files(spark, path)
    if files is None:
        return spark.createDataFrame([], FILES)
    return files.filter("length > 0").select(
        "path",
        F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("name"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
        F.col("_metadata.file_path").alias("location"),
    )


def expected_or_newest(spark: SparkSession, folder: str, expected: str, pattern: str) -> str:
    """Path of the expected file, else of the newest one matching the pattern. An action."""
    files = list_files(spark, f"{folder.rstrip('/')}/*")
    # Turn the glob into a LIKE pattern; '_' is literal in file names.
    like = pattern.replace("\\", "\\\\").replace("_", "\\_").replace("%", "\\%").replace("*", "%").replace("?", "_")
    wanted = files.filter((F.col("name") == expected) | F.col("name").like(like))
    best = wanted.orderBy((F.col("name") == expected).desc(), F.col("modified").desc(), "name").first()
    if best is None:
        raise FileNotFoundError(f"neither {expected} nor {pattern} in {folder}")
    return best.path


def require_content(spark: SparkSession, path: str) -> None:
    """A missing or zero-byte report is an error. An action."""
    files = _files(spark, path)
    if files is None:
        raise FileNotFoundError(f"no report at {path}")
    if list_files(spark, path).count() < len(files.inputFiles()):
        raise RuntimeError(f"empty report at {path}")


UNNAMED = re.compile(r"_c\d+")


def read_text_columns(
    spark: SparkSession, path: str | Sequence[str], sep: str, encoding: str,
    na_as_null: bool = False, line_breaks: bool = True, unnamed: bool = False,
    partitions: int | None = None, origin: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A CSV report with a header, all columns as text.

    Columns without a header are called ``_c<position>`` and left out unless ``unnamed``. Files read together must
    share one header, or the read fails. Quoted values may hold line breaks; files are split all the same, at the cost
    of a scan for quotes before. ``line_breaks=False`` promises that there are none and spares it. Files that cannot be split
    (compressed ones, and encodings that are not bytewise) are read by one task each, and ``partitions`` deals out their rows. ``origin``
    adds columns, of the file's metadata for example.
    """
    paths = [path] if isinstance(path, str) else list(path)
    origin = dict(origin or {})
    if line_breaks and encoding.upper() in records.BYTEWISE:
        df = _split_records(spark, paths, sep, encoding, origin)
    else:
        df = _whole_files(spark, paths, sep, encoding, line_breaks, origin)
    columns = []
    for name in df.columns[: len(df.columns) - len(origin)]:
        if unnamed or not UNNAMED.fullmatch(name):
            col = F.col(f"`{name}`")
            columns.append((null_if_na(col) if na_as_null else col).alias(name))
    df = df.select(*columns, *[F.col(f"`{name}`") for name in origin])
    return df.repartition(partitions) if partitions else df


def _split_records(spark: SparkSession, paths: list[str], sep: str, encoding: str, origin: dict[str, Column]) -> DataFrame:
    """The report's columns and those of ``origin``, from records put together across byte ranges."""
    first = sorted(spark.read.text(paths).inputFiles())[0]
    header = records.first_header(spark, first, sep)
    fields = records.header_fields(header, sep, encoding)
    rows = records.read_records(spark, paths, sep, origin, header, encoding)
    schema = ", ".join(f"c{i} string" for i in range(len(fields)))
    parsed = F.from_csv(records.decoded(F.col("record"), encoding), schema, {"sep": sep, "escape": '"', "multiLine": "true"})
    rows = rows.select(parsed.alias("_parsed"), *[F.col(f"`{name}`") for name in origin])
    named = [F.col(f"_parsed.c{i}").alias(name) for i, name in enumerate(records.column_names(fields))]
    return rows.select(*named, *[F.col(f"`{name}`") for name in origin])


def _whole_files(spark: SparkSession, paths: list[str], sep: str, encoding: str, line_breaks: bool, origin: dict[str, Column]) -> DataFrame:
    """The same by Spark's reader, which splits files only without line breaks in values. Headers are read before, one line per file."""
    reader = functools.partial(
        spark.read.csv, sep=sep, encoding=encoding, header=True, inferSchema=False, escape='"', multiLine=line_breaks,
    )
    df = without_bom(reader(paths))
    files = df.inputFiles()
    if len(files) > 1:
        for file in files:
            header = without_bom(reader([file])).columns
            if header != df.columns:
                raise ValueError(f"the header of {file} differs from the first file's: {header} against {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[col.alias(name) for name, col in origin.items()])


def read_trip_report(
    spark: SparkSession, path: str, line_breaks: bool = True, partitions: int | None = None,
) -> DataFrame:
    require_content(spark, path)
    return read_text_columns(
        spark, path, ";", "ISO-8859-1", na_as_null=True, line_breaks=line_breaks, partitions=partitions,
    )


def read_fleet_report(spark: SparkSession, path: str) -> DataFrame | None:
    """The stamped snapshot; None if there is none."""
    if list_files(spark, path).isEmpty():
        return None
    return read_text_columns(spark, path, ",", "UTF-8", na_as_null=True)


def read_schedule_extract(spark: SparkSession, path: str) -> DataFrame:
    """The schedule extract before it is stamped."""
    return read_text_columns(spark, path, ";", "UTF-8", na_as_null=True)


def can_file(day: date) -> str:
    return f"CAN-{day:%d%m%y}.csv"


def days_between(first: date, last: date) -> list[date]:
    if last < first:
        raise ValueError(f"{last} lies before {first}")
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def read_can_reports(
    spark: SparkSession, folder: str, first: date, last: date,
    line_breaks: bool = True, partitions: int | None = None,
) -> tuple[DataFrame | None, list[date]]:
    """Telemetry of all days in one scan with a ``report_day`` column, and the days without a file.

    Files are looked up before the read; a file name must belong to a day of the range.
    """
    wanted = {can_file(d): d for d in days_between(first, last)}
    listed = list_files(spark, f"{folder.rstrip('/')}/CAN-*.csv")
    # At most one file per day of the range.
    found = {r.name: r.path for r in listed.filter(F.col("name").isin(*wanted)).collect()}
    skipped = [d for n, d in wanted.items() if n not in found]
    if not found:
        return None, skipped
    df = read_text_columns(
        spark, sorted(found.values()), ";", "ISO-8859-1", na_as_null=True, line_breaks=line_breaks,
        partitions=partitions, origin={"_file": F.col("_metadata.file_name")},
    )
    tag = F.regexp_extract("_file", r"CAN-(\d{6})\.csv$", 1)
    return df.withColumn("report_day", F.to_date(tag, "ddMMyy")).drop("_file"), skipped
