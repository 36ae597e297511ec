"""History tables: names, range replace, guarded rebuild.

A history is a versioned table in Parquet, partitioned by ``service_week``. New contents are staged as a table of
their own, checked, and only then put in place; a job that dies in between leaves the stage, and the next run
finishes or discards it first. A version is a table of its own whose unchanged weeks are the files of the version before.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.functions import calendar, clock
from cadencia.operators.ranges import (
    RangeKey,
    check_window,
    check_window_arguments,
    in_window,
    range_replaced,
)
from cadencia.plans.versions import (
    KEPT_VERSIONS,
    as_properties,
    checked_name,
    current,
    data_folder,
    discard_plain,
    drop_folders,
    folders,
    locked,
    properties,
    publish,
    quoted,
)
from cadencia.schemas import PARTITION_COLUMN
from cadencia.session import delete_folder, materialize, shared_dir

_log = logging.getLogger(__name__)
_STAGED = "__staged"
_WEEKS, _ROWS = "touched_weeks", "staged_rows"
#: Property of a version, one per week: the folder that the week's files are in.
_FOLDER = "cadencia.week."
#: How Spark names the folder of rows without a week.
NO_WEEK = "__HIVE_DEFAULT_PARTITION__"


def row_count(spark: SparkSession, table: str) -> int | None:
    """Rows of the table, None if there is none."""
    return spark.table(quoted(table)).count() if spark.catalog.tableExists(checked_name(table)) else None


def with_week(df: DataFrame, key: RangeKey) -> DataFrame:
    """Put the service week of the row's instant last, as the partition column."""
    week = calendar.service_week(key.column(df))
    return df.drop(PARTITION_COLUMN).withColumn(PARTITION_COLUMN, week)


def create_history(df: DataFrame, table: str, key: RangeKey) -> None:
    """Create the table from its first rows, which may be none."""
    spark = df.sparkSession
    with locked(spark, checked_name(table)):
        if spark.catalog.tableExists(table):
            raise ValueError(f"{table} exists")
        _new_version(spark, table, with_week(df, key), {})


def _new_version(spark: SparkSession, table: str, weekly: DataFrame, kept: dict[str, str]) -> None:
    """Write ``weekly``, whole weeks, and publish them with the other weeks ``kept`` (week -> folder) of the version before."""
    data, folder = data_folder(spark, table), uuid.uuid4().hex
    # A few even files per week instead of one per task and week; a heavy week is split.
    weekly.hint("rebalance", PARTITION_COLUMN).write.partitionBy(PARTITION_COLUMN).parquet(f"{data}/{folder}")
    before = current(spark, table)
    number = int(before.rsplit("__v", 1)[1]) + 1 if before else 1
    version = f"{table}__v{number}"
    # What a run left that died before it published.
    spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in weekly.schema)
    written = [f.removeprefix(f"{PARTITION_COLUMN}=") for f in folders(spark, f"{data}/{folder}") if f.startswith(f"{PARTITION_COLUMN}=")]
    weeks = {**kept, **dict.fromkeys(written, folder)}
    noted = as_properties({"cadencia.number": number, **{f"{_FOLDER}{w}": f for w, f in weeks.items()}})
    spark.sql(f"CREATE TABLE {quoted(version)} ({columns}) USING parquet PARTITIONED BY ({PARTITION_COLUMN}) LOCATION '{data}' TBLPROPERTIES ({noted})")
    places = [f"PARTITION ({PARTITION_COLUMN}={_literal(w)}) LOCATION '{data}/{f}/{PARTITION_COLUMN}={w}'" for w, f in sorted(weeks.items())]
    for at in range(0, len(places), 500):
        spark.sql(f"ALTER TABLE {quoted(version)} ADD IF NOT EXISTS {' '.join(places[at : at + 500])}")
    publish(spark, table, quoted(version), version, weekly.columns)
    discard_plain(spark, table)
    _forget_versions(spark, table, number)


def _literal(week: str) -> str:
    return "NULL" if week == NO_WEEK else f"DATE'{week}'"


def week_folders(spark: SparkSession, version: str) -> dict[str, str]:
    """Week -> folder of a version."""
    return {k.removeprefix(_FOLDER): v for k, v in properties(spark, version).items() if k.startswith(_FOLDER)}


def _forget_versions(spark: SparkSession, table: str, number: int) -> None:
    """Drop versions that no reader should hold any more, and the folders that none of the others names."""
    schema, name = table.rsplit(".", 1)
    used: set[str] = set()
    for found in spark.catalog.listTables(schema, f"{name}__v*"):
        version = f"{schema}.{found.name}"
        if int(found.name.rsplit("__v", 1)[1]) > number - KEPT_VERSIONS:
            used |= set(week_folders(spark, version).values())
        else:
            spark.sql(f"DROP TABLE {quoted(version)}")
    drop_folders(spark, data_folder(spark, table), used)


def drop_history(spark: SparkSession, table: str) -> None:
    """The table, its versions and their files."""
    with locked(spark, checked_name(table)):
        spark.sql(f"DROP VIEW IF EXISTS {quoted(table)}")
        schema, name = table.rsplit(".", 1)
        for found in spark.catalog.listTables(schema, f"{name}__v*"):
            spark.sql(f"DROP TABLE {quoted(f'{schema}.{found.name}')}")
        delete_folder(spark, data_folder(spark, table))


def weeks_touched(start: datetime, end: datetime) -> list[date]:
    """Service weeks that overlap the half-open window."""
    first = calendar.service_week_of(start)
    last = calendar.service_week_of(end - timedelta(microseconds=1))
    return [first + timedelta(weeks=i) for i in range((last - first).days // 7 + 1)]


def _strays(weekly: DataFrame, key: RangeKey, start: datetime, end: datetime) -> DataFrame:
    """Week and instant of the rows outside the window, each once."""
    at = key.column(weekly)
    outside = weekly.filter(~F.coalesce(in_window(at, start, end), F.lit(False)))
    return outside.select(F.col(PARTITION_COLUMN).alias("stray_week"), at.alias("stray_at")).distinct()


def replace_range(
    new: DataFrame, table: str, key: RangeKey, start: datetime, end: datetime,
    date_type: str = "TIMESTAMP", stray: str = "keep",
) -> int:
    """Replace the rows of ``[start, end)`` by ``new``; running it again changes nothing.

    The guard looks at rows with a main time. A row without one is placed by the fallback time, or at midnight, and
    may fall outside the window. ``stray="keep"`` loads such rows in place of those without a main time that stand
    at the same instants, which are the ones an earlier run of the report left; ``stray="reject"`` refuses
    them. ``new`` is computed once, into the stage, and checked there; only the touched weeks of the table are read
    and rewritten. Returns the number of new rows.
    """
    check_window_arguments(start, end, date_type)
    if stray not in ("reject", "keep"):
        raise ValueError(f"stray must be 'reject' or 'keep', not {stray!r}")
    with locked(new.sparkSession, table):
        return _replace(new, table, key, start, end, stray)


def _replace(new: DataFrame, table: str, key: RangeKey, start: datetime, end: datetime, stray: str) -> int:
    spark = new.sparkSession
    finish_replace(spark, table)
    weekly = with_week(new, key)
    # Not in this application's scratch folder: a later application may have to finish the replace.
    path = f"{shared_dir(spark)}/cadencia-stages/{uuid.uuid4().hex}"
    try:
        written = _stage(weekly, path, new, table, key, start, end, stray)
    except Exception:
        if not spark.catalog.tableExists(table + _STAGED):
            delete_folder(spark, path)
        raise
    staged = spark.table(quoted(table + _STAGED))
    staged_rows, staged_weeks = staged.count(), materialize(staged.select(PARTITION_COLUMN).distinct(), "weeks")
    finish_replace(spark, table)
    stored = spark.table(quoted(table)).join(staged_weeks, PARTITION_COLUMN, "left_semi").count()
    if stored != staged_rows:
        raise RuntimeError(f"{table}: {stored} rows in the touched weeks, {staged_rows} were staged")
    return written


def _stage(
    weekly: DataFrame, path: str, new: DataFrame, table: str, key: RangeKey, start: datetime, end: datetime, stray: str,
) -> int:
    """Write and check the stage and enter it in the catalog, with its weeks and number of rows; returns the number of new rows."""
    spark = new.sparkSession
    weekly.write.parquet(path)
    staged_new = spark.read.schema(weekly.schema).parquet(path)
    written = check_window(staged_new, key, start, end)
    strays = materialize(_strays(staged_new, key, start, end), "strays")
    if stray == "reject" and not strays.isEmpty():
        raise RuntimeError(f"rows without {key.time} lie outside the window, the first at {strays.agg(F.min('stray_at')).first()[0]}")
    if not spark.catalog.tableExists(checked_name(table)):
        create_history(spark.createDataFrame([], new.schema), table, key)
    weeks = weeks_touched(start, end)
    current = spark.table(quoted(table))
    inside = F.col(PARTITION_COLUMN).isin(weeks)
    # Weeks of strays are found by a join on the partition column, which prunes the scan.
    more = current.filter(~inside).join(strays.select(F.col("stray_week").alias(PARTITION_COLUMN)).distinct(), PARTITION_COLUMN, "left_semi")
    touched = current.filter(inside).unionByName(more)
    kept = range_replaced(touched, touched.limit(0), key, start, end)
    left_before = clock.seconds_of_day(kept, key.time).isNull() & (key.column(kept) == F.col("stray_at"))
    kept = kept.join(strays, left_before, "left_anti")
    kept.select(*weekly.columns).write.mode("append").parquet(path)
    listed = ",".join(w.isoformat() for w in weeks)
    rows = spark.read.schema(weekly.schema).parquet(path).count()
    spark.sql(
        f"CREATE TABLE {quoted(table + _STAGED)} USING parquet LOCATION '{path}' "
        f"TBLPROPERTIES ('{_WEEKS}'='{listed}', '{_ROWS}'='{rows}')"
    )
    return written


def finish_replace(spark: SparkSession, table: str) -> bool:
    """Put a stage in place that an earlier run completed; True if there was one.

    The stage enters the catalog only once it is complete and checked, so doing this twice is safe. A stage that no
    longer holds the rows it was entered with is an error and leaves the history as it was.
    """
    staged_name = checked_name(table) + _STAGED
    if not spark.catalog.tableExists(staged_name):
        return False
    properties_ = properties(spark, staged_name)
    present = spark.table(quoted(staged_name)).count()
    if properties_.get(_ROWS) != str(present):
        raise RuntimeError(
            f"{staged_name} holds {present} rows, {properties_.get(_ROWS, 'an unknown number')} were staged; nothing was replaced, "
            "drop the stage and load the report again"
        )
    with locked(spark, table):
        staged = spark.table(quoted(staged_name)).select(*[f"`{c}`" for c in spark.table(quoted(table)).columns])
        listed = properties_[_WEEKS].split(",")
        before = current(spark, table)
        if before is None:
            # A plain table of an earlier release: its other weeks move into the first version.
            gone = staged.select(PARTITION_COLUMN).distinct()
            others = spark.table(quoted(table)).filter(~F.coalesce(F.col(PARTITION_COLUMN).cast("string").isin(listed), F.lit(False)))
            same_week = others[PARTITION_COLUMN].eqNullSafe(gone[PARTITION_COLUMN])
            _new_version(spark, table, staged.unionByName(others.join(gone, same_week, "left_anti")), {})
        else:
            kept = {week: folder for week, folder in week_folders(spark, before).items() if week not in listed}
            _new_version(spark, table, staged, kept)
        _drop_stage(spark, staged_name)
    return True


def _drop_stage(spark: SparkSession, staged_name: str) -> None:
    location = spark.sql(f"DESCRIBE FORMATTED {quoted(staged_name)}").filter("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {quoted(staged_name)}")
    delete_folder(spark, location)  # an external table's files outlive it


def render(sql: str) -> str:
    """The query of a rebuild names its source by parameter only."""
    if "IDENTIFIER(:source_table)" not in sql:
        raise RuntimeError("the query must read IDENTIFIER(:source_table), not a fixed table")
    return sql.strip().rstrip(";")


_UNITS = {"B": 1, **{f"{prefix}iB": 1024**power for power, prefix in enumerate("KMGTPE", 1)}}


def dry_run(spark: SparkSession, sql: str, source_table: str) -> tuple[DataFrame, str]:
    """Analyse a query without running it: its lazy result and the estimated size of all it scans.

    Syntax errors and missing tables raise here.
    """
    args = {"source_table": quoted(checked_name(source_table, "source_table"))}
    query = spark.sql(render(sql), args=args)
    plan = spark.sql(f"EXPLAIN COST {render(sql)}", args=args).first()[0]
    # The optimized plan comes first; every relation in it is a line of its own.
    sizes = re.findall(r"Relation.*sizeInBytes=([0-9.Ee+]+) ([KMGTPE]?i?B)", plan.split("== Physical Plan ==")[0])
    return query, f"{sum(round(float(n) * _UNITS[u]) for n, u in sizes)} B" if sizes else "unknown"


def rebuild_table(
    spark: SparkSession, sql: str, source_table: str, dest_table: str, min_row_ratio: float = 0.9
) -> int:
    """Create or replace ``dest_table`` from a query over the full source; returns its rows.

    The new contents are complete and checked before they are published, in one statement: no rows, or fewer
    than ``min_row_ratio`` of the rows before, is an error and leaves the old contents as they were.
    """
    checked_name(dest_table, "dest_table")
    query, scanned = dry_run(spark, sql, source_table)
    _log.info("rebuilding %s, which scans %s", dest_table, scanned)
    return put_version(spark, dest_table, query, min_row_ratio)


def put_version(
    spark: SparkSession, dest_table: str, rows: DataFrame, min_row_ratio: float = 0.9, beside: Mapping[str, DataFrame] | None = None,
) -> int:
    """Make ``rows`` the contents of ``dest_table``, written and checked before they are published; returns how many.

    What is put ``beside`` them is Parquet in the version's folder under ``_beside``, which its readers do not see, and comes and
    goes with the version.
    """
    with locked(spark, checked_name(dest_table, "dest_table")):
        before = row_count(spark, dest_table)
        data, version = data_folder(spark, dest_table), uuid.uuid4().hex
        # The published version and the one before stay for readers that began with them.
        old = current(spark, dest_table)
        earlier = [f for f in folders(spark, data) if f != old]
        path = f"{data}/{version}"
        rows.write.parquet(path)
        after = spark.read.schema(rows.schema).parquet(path).count()
        fault = None
        if after == 0:
            fault = f"{dest_table}: the query gave no rows"
        elif before is not None and after < int(before * min_row_ratio):
            fault = f"{dest_table} would shrink from {before} to {after} rows"
        if fault:
            delete_folder(spark, path)
            raise RuntimeError(fault)
        for name, extra in (beside or {}).items():
            extra.write.parquet(f"{path}/_beside/{name}")
        publish(spark, dest_table, f"parquet.`{path}`", version, rows.columns)
        discard_plain(spark, dest_table)
        drop_folders(spark, data, {version, old or version, *earlier[len(earlier) - (KEPT_VERSIONS - 2) :]})
    return after
