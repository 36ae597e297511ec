"""Composite jobs. Every failure propagates."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from importlib import resources
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.functions import calendar, clock, shifts
from cadencia.functions.text import null_if_na
from cadencia.operators.can_text import branded_rows, parse_can
from cadencia.operators.can_wide import can_wide, layouts
from cadencia.operators.fleet import fleet_snapshot, stamp_snapshot
from cadencia.operators.outliers import warn_if_over_cut, without_outliers
from cadencia.operators.ranges import RangeKey
from cadencia.operators.stamps import INFER, inferred_format
from cadencia.operators.trips import headways, typed_trips
from cadencia.plans.gaps import refresh_gaps
from cadencia.plans.store import replace_range
from cadencia.schemas import BRANDS
from cadencia.session import ensure_time_type, materialize
from cadencia.sources.landing import ORIGIN, land_report, landed
from cadencia.sources.reports import (
    UNNAMED,
    days_between,
    expected_or_newest,
    list_files,
    read_can_reports,
    read_fleet_report,
    read_schedule_extract,
    require_content,
)
from cadencia.sources.sinks import append_table, output_path, write_csv

TRIP_KEY = RangeKey("FECHA", "PARTIDA_REAL", "PARTIDA_PLANEADA")
HEADWAY_KEY = RangeKey("FECHA", "PARTIDA_REAL")
SCHEDULED_GAPS_SQL = resources.files("cadencia.plans").joinpath("scheduled_gaps.sql").read_text("utf-8")


class TripTables(NamedTuple):
    trips: str
    headways: str
    gaps: str


def landed_trip_report(spark: SparkSession, landing: str, raw_path: str) -> DataFrame:
    """The landed rows of the files that ``raw_path`` names now, in their present version, missing-value tokens as nulls."""
    raw = landed(spark, landing, "trips", versions="all", paths=raw_path).drop(*ORIGIN, "report")
    return raw.select(*[null_if_na(F.col(f"`{c}`")).alias(c) for c in raw.columns if not UNNAMED.fullmatch(c)])


def run_trips(
    spark: SparkSession, raw_path: str, start: datetime, end: datetime, tables: TripTables,
    landing: str, remove_outliers: bool = True, stray: str = "keep", line_breaks: bool = True, out_root: str | None = None,
) -> dict[str, int]:
    """Weekly trips: land the report, replace the week in both histories, bring the scheduled gaps up to it.

    The CSV is parsed once, by the landing; both branches read the landed columns. A file that was corrected
    under its old name is landed as a new version, and its rows are the ones that count. The gaps come
    from the trip table and therefore strictly after it, recomputed for the dates and routes that changed. ``out_root`` receives the processed tables as CSV, named
    after the raw file. Returns rows written per table.
    """
    ensure_time_type(spark)
    require_content(spark, raw_path)
    land_report(spark, raw_path, "trips", f"{start:%Y-%m-%d}", landing, line_breaks=line_breaks)
    raw = landed_trip_report(spark, landing, raw_path)
    trips = typed_trips(raw)
    written = {tables.trips: replace_range(trips, tables.trips, TRIP_KEY, start, end, stray=stray)}
    rows = materialize(headways(raw), "headways")
    if remove_outliers:
        inliers = materialize(without_outliers(rows, stored=True), "headway-inliers")
        warn_if_over_cut(rows.count(), inliers.count())
        rows = inliers
    written[tables.headways] = replace_range(
        rows, tables.headways, HEADWAY_KEY, start, end, date_type="DATETIME", stray=stray
    )
    if out_root:
        name = list_files(spark, raw_path).orderBy("name").first()["name"]
        for label, df in (("trips", trips), ("headways", rows)):
            write_csv(df, output_path(out_root, label, name))
    written[tables.gaps] = refresh_gaps(spark, tables.trips, tables.gaps).rows
    return written


def run_can(
    spark: SparkSession, folder: str, first: date, last: date, out_dir: str,
    formats: Sequence[str] = clock.STAMP_FORMATS, line_breaks: bool = True, unreadable: str = "fail",
) -> tuple[DataFrame, list[date]]:
    """Telemetry of a range of days: one scan, one wide output per brand and day.

    ``formats`` may be ``["infer"]``: then the one format counts that reads every stamp of the range, and two that do so
    differently are an error. Returns rows per day and brand (zero rows included) and the days without a file. Days of a brand
    whose columns agree are written together, to ``out_dir/<brand>/report_day=...``.
    """
    raw, skipped = read_can_reports(spark, folder, first, last, line_breaks)
    if raw is None:
        return can_summary(spark, None, []), skipped
    branded = branded_rows(raw)
    if tuple(formats) == (INFER,):
        inferred = inferred_format(branded, "Fecha")
        formats = clock.STAMP_FORMATS if inferred is None else (inferred,)
    parsed = materialize(parse_can(branded), "can-parsed", partition_by=("brand", "report_day"))
    drop = {b.name: b.drop for b in BRANDS}
    per_brand: dict[str, list] = {}
    for layout in layouts(parsed, ("brand", "report_day")):
        for brand in sorted({s[0] for s in layout.slots}):
            per_brand.setdefault(brand, []).append((layout.profiles, [s[1] for s in layout.slots if s[0] == brand]))

    def write(brand: str) -> None:
        for profiles, days in per_brand[brand]:
            rows = parsed.filter((F.col("brand") == brand) & F.col("report_day").isin(days))
            wide = can_wide(rows, profiles, drop[brand], formats, unreadable=unreadable)
            (
                wide.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("report_day")
                .parquet(f"{out_dir.rstrip('/')}/{brand.replace(' ', '_')}")
            )

    # A brand's folder has one writer; the brands, six at most, are written at the same time.
    with ThreadPoolExecutor(len(BRANDS)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), sorted(per_brand)))
    done = [d for d in days_between(first, last) if d not in skipped]
    return can_summary(spark, parsed, done), skipped


def can_summary(spark: SparkSession, parsed: DataFrame | None, days: Sequence[date]) -> DataFrame:
    """Rows per processed day and brand, 0 where a brand has none."""
    slots = spark.createDataFrame(
        [(d, b.name) for d in days for b in BRANDS], "report_day date, brand string"
    )
    if parsed is None:
        return slots.withColumn("n_rows", F.lit(0).cast("bigint"))
    counted = parsed.groupBy("report_day", "brand").agg(F.count("*").alias("n"))
    return slots.join(counted, ["report_day", "brand"], "left").select(
        "report_day", "brand", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows")
    )


def run_fleet(spark: SparkSession, path: str, table: str | None = None) -> DataFrame | None:
    """Fleet snapshot; None if there is no file. Appended to ``table`` if one is named."""
    raw = read_fleet_report(spark, path)
    if raw is None:
        return None
    snapshot = fleet_snapshot(raw)
    if table:
        append_table(snapshot, table)
    return snapshot


def run_stamp(spark: SparkSession, path: str, out: str, at: datetime | None = None) -> int:
    """Date and shift of ``at`` (default: now, local) put before a schedule extract, written as CSV; returns its rows."""
    at = at or calendar.wall_clock()
    stamped = stamp_snapshot(read_schedule_extract(spark, path), at.date(), shifts.clock_shift(F.lit(at.hour)))
    write_csv(stamped, out)
    return stamped.count()


# Reports that are only landed; their columns are not interpreted.
LANDED_REPORTS = ("circuits_detailed", "circuits_executive", "withdrawals", "operators", "trips")


def default_window_start(report: str) -> date:
    """Where a land-only report's window begins: Friday's week for operators, yesterday for withdrawals, else the calendar week."""
    if report == "operators":
        return calendar.last_friday_week()[0]
    if report == "withdrawals":
        return calendar.yesterday()
    return calendar.last_calendar_week()[0]


def run_landing(
    spark: SparkSession, paths: str | Sequence[str], report: str, window_start: date, landing: str,
    line_breaks: bool = True, expected: str | None = None, pattern: str | None = None,
) -> list[str]:
    """Land files unchanged; returns the names of those that were new.

    With ``expected`` one file of the folder ``paths`` is landed: the one of that name, else the newest whose name fits ``pattern``.
    """
    if report not in LANDED_REPORTS and not report.startswith("can_"):
        raise ValueError(f"unknown report {report!r}")
    if expected is not None:
        (folder,) = [paths] if isinstance(paths, str) else paths
        paths = expected_or_newest(spark, folder, expected, pattern or expected)
    elif pattern is not None:
        raise ValueError("a pattern stands for a file that is expected; name that file too")
    return land_report(spark, paths, report, window_start.isoformat(), landing, line_breaks=line_breaks)
