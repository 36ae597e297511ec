"""Processed output: CSV at the edges, appends with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimeType

from cadencia.functions import clock
from cadencia.operators.audit import compare_schemas
from cadencia.sources.records import decoded, read_records


def csv_ready(df: DataFrame) -> DataFrame:
    """TIME columns and timestamps as text; the CSV writer takes no TIME."""
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimeType):
            col = clock.clock_text(clock.seconds_of_day(df, field.name))
        elif field.dataType.simpleString() in ("timestamp", "timestamp_ntz"):
            col = clock.stamp_text(col)
        columns.append(col.alias(field.name))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma, UTF-8, header; quoted where a value needs it."""
    csv_ready(df).write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def output_path(root: str, table: str, raw_name: str) -> str:
    """``root/table/table_<suffix>`` from a raw file named ``RV_<suffix>.csv``."""
    suffix = raw_name.rsplit("/", 1)[-1].removesuffix(".csv").removeprefix("RV_")
    return f"{root.rstrip('/')}/{table}/{table}_{suffix}"


def read_processed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Processed CSV by position under an explicit schema; one unreadable row fails the read. Files are split, line breaks in values or not."""
    clocks = [f.name for f in schema if isinstance(f.dataType, TimeType)]
    text = StructType(
        [StructField(f.name, StringType()) if f.name in clocks else f for f in schema]
    )
    positions = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(text)])
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in positions)
    rows = read_records(spark, path, ",")
    parsed = rows.select(F.from_csv(decoded(F.col("record"), "UTF-8"), fields, options).alias("_row"))
    raw = parsed.select(*[F.col(f"_row.c{i}").alias(f.name) for i, f in enumerate(schema)])
    bad = lambda c: F.raise_error(F.concat(F.lit("not a time of day: "), c))
    restored = []
    for field in schema:
        col = F.col(f"`{field.name}`")
        if field.name in clocks:
            seconds = clock.clock_seconds(col)
            col = F.when(col.isNull() | seconds.isNotNull(), clock.time_of_day(seconds)).otherwise(
                bad(col).cast("time")
            )
        restored.append(col.alias(field.name))
    return raw.select(*restored)


def append_table(df: DataFrame, table: str) -> None:
    """Append, creating the table on first use; columns are matched by name, and any other difference is an error."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        verdict = compare_schemas(df.schema, spark.table(table).schema)
        if not verdict.same:
            raise ValueError(f"rows do not fit {table}: {'; '.join(verdict.messages)}")
        df = df.select(*[f"`{c}`" for c in spark.table(table).columns])
        df.write.mode("append").insertInto(table)
    else:
        df.write.saveAsTable(table)


def dump_discrepancies(rows: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """The discrepancy report as CSV, side column first."""
    order = columns or [c for c in rows.columns if c != "side"]
    write_csv(rows.select("side", *[f"`{c}`" for c in order]), path)
