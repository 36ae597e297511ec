"""One query per operator or job, over whole driver tables."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.functions import calendar, clock, numbers, shifts
from cadencia.functions.text import null_if_na, strip_accents, with_warehouse_names, without_bom
from cadencia.operators import audit, fleet, ranges, schedule, trips
from cadencia.operators.can_text import PAIRS, branded_rows, brand_counts, parse_can, squeezed
from cadencia.operators.can_wide import can_wide, layouts, unit_profile
from cadencia.operators.outliers import without_outliers
from cadencia.operators.stamps import inferred_format
from cadencia.plans import jobs
from cadencia.plans.audit import audit_frames
from cadencia.plans.gaps import refresh_gaps
from cadencia.plans.store import create_history, quoted, rebuild_table, replace_range
from cadencia.schemas import BRANDS, PARTITION_COLUMN, trip_schema
from cadencia.session import ensure_time_type, materialize, path_exists, scratch_dir
from cadencia.sources.landing import land_report, landed
from cadencia.sources.reports import can_file, expected_or_newest, read_text_columns
from cadencia.sources.sinks import append_table, read_processed_csv, write_csv

from checks.views import altered_lineitem, can_rows, event_notes, fleet_rows, raw_trips, table

WEEK = (datetime(2024, 1, 8, 3, 20), datetime(2024, 1, 15, 3, 20))
MONTH = (datetime(2024, 1, 1), datetime(2024, 2, 1))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and times as text, so that no engine's types or settings show."""
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = clock.stamp_text(col)
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.TimeType):
            col = clock.clock_text(clock.seconds_of_day(df, field.name))
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(run: Query) -> Query:
    def portable_run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(run(spark, sf_dir))

    QUERIES[run.__name__] = portable_run
    return run


def scratch_schema(spark: SparkSession) -> str:
    """A catalog schema of its own, with its files in the shared folder."""
    name = f"cadencia_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_dir(spark)}/{name}'")
    return name


def typed(spark: SparkSession, sf_dir: str, bad_days: bool = True) -> DataFrame:
    """Trip table with times as text, which needs no session setting."""
    return trips.typed_trips(raw_trips(spark, sf_dir, bad_days), clock_as="text")


# Trips, headways, schedule


@query
def scheduled_gap_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.scheduled_gaps(typed(spark, sf_dir))


@query
def trips_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(spark, sf_dir)


def _portable_order(raw: DataFrame) -> Column:
    """A tie order both engines can compute: leading bits of an MD5 over the row's text."""
    joined = F.concat_ws("|", *[F.col(f"`{c}`") for c in raw.columns])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


@query
def headway_punctuality(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    return trips.headways(raw, order_key=_portable_order(raw))


@query
def headway_without_unmapped_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    kept = trips.headways(raw, unmapped_shift="drop", order_key=_portable_order(raw))
    return kept.groupBy("FECHA", "RUTA", "TURNO").agg(
        F.count("*").alias("n_rows"),
        F.max("INTERVALO_MINUTOS").alias("max_gap"),
        F.min("INTERVALO_MINUTOS").alias("min_gap"),
    )


@query
def headway_inliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomaly model by what must hold whatever trees are drawn: rows per route before, that at least one but not much
    more than the set share goes, and that a route of fewer than two rows stays whole. One planted extreme per route goes."""
    rows = trips.headways(raw_trips(spark, sf_dir)).withColumn("planted", F.lit(False))
    ends = rows.groupBy("RUTA").agg(*[F.max(c).alias(c) for c in rows.columns if c not in ("RUTA", "planted")])
    extreme = ends.withColumns({
        "planted": F.lit(True), "DIFF_PARTIDA": F.lit(9e5), "INTERVALO_MINUTOS": F.lit(9e5), "ECONOMICO": F.lit(9e6),
    })
    base = materialize(rows.unionByName(extreme), "inliers-in")
    kept = materialize(without_outliers(base, stored=True), "inliers-out")
    before = base.groupBy("RUTA").agg(F.count("*").alias("n_before"))
    after = kept.groupBy(F.col("RUTA").alias("r")).agg(F.count("*").alias("n_after"), F.count_if("planted").alias("planted_left"))
    removed = F.col("n_before") - F.coalesce("n_after", F.lit(0))
    return before.join(after, F.col("RUTA") == F.col("r"), "left").select(
        "RUTA", "n_before", F.coalesce("planted_left", F.lit(0)).alias("planted_left"),
        ((removed >= 1) & (removed <= F.ceil(F.col("n_before") * 0.01))).alias("share_kept"),
    )


@query
def signed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    texts = {"Diff Partida": "early_departure", "HE": "early_start", "Diff llegada": "early_arrival"}
    return raw.select(
        "Fecha", "Ruta", "Diff Partida", "HE",
        *[numbers.signed_minutes(F.col(f"`{c}`"), True).alias(n) for c, n in texts.items()],
        numbers.signed_minutes(F.col("HE"), False).alias("natural_start"),
        numbers.signed_minutes(F.col("`Tiempo Viaje`"), False).alias("trip_minutes"),
    )


@query
def shift_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    label = F.coalesce(shifts.departure_shift(hour), F.lit(shifts.UNMAPPED_SHIFT))
    events = table(spark, sf_dir, "events")
    return events.groupBy(hour.alias("hour"), label.alias("shift")).agg(F.count("*").alias("n_rows"))


@query
def shift_by_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    shift = shifts.clock_shift(F.hour("ts"))
    return events.groupBy("event_type", shift.alias("shift")).agg(F.count("*").alias("n_rows"))


@query
def stamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and stamps written in several formats, read back."""
    events = table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "d/M/yyyy"))
        .otherwise("sin fecha")
    )
    staged = events.select("event_id", "ts", text.alias("stamp"))
    seconds = (F.hour("at") * 3600 + F.minute("at") * 60 + F.second("at")).cast("int")
    return staged.withColumn("at", clock.report_stamp(F.col("stamp"), unreadable="null")).select(
        "event_id",
        "stamp",
        clock.midnight(F.col("at")).alias("day"),
        F.when(F.col("at").isNotNull(), clock.clock_text(seconds)).alias("time_of_day"),
        clock.report_day(F.col("stamp")).alias("plain_day"),
        clock.day_tag(F.col("ts")).alias("day_tag"),
        clock.strict_compact_day(F.date_format("ts", "yyyyMMdd")).alias("compact_day"),
    )


@query
def whole_second_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences in whole seconds and minutes between an order's lines' date and the order."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    seconds = clock.whole_seconds_between(F.col("o_orderdate"), F.col("l_shipdate"))
    late = F.greatest(seconds, F.lit(0))
    return joined.groupBy(seconds.alias("seconds")).agg(
        F.count("*").alias("n_rows"),
        F.max(clock.gap_minutes(seconds)).alias("minutes"),
        F.max(clock.gap_text(late)).alias("late_text"),
    )


@query
def missing_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens for missing values, and names without accents, over the documents' fields."""
    documents = table(spark, sf_dir, "documents")
    token = F.when(F.col("doc_id") % 3 == 0, "NA").when(F.col("doc_id") % 3 == 1, "-").otherwise(F.col("lang"))
    return documents.select(
        "doc_id",
        null_if_na(token).alias("token"),
        strip_accents(F.concat(F.lit("Económico Ñandú "), F.col("source"))).alias("plain"),
        F.md5(strip_accents(F.col("text"))).alias("text_md5"),
    )


# Calendar


@query
def service_week_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    ts = F.col("ts")
    return events.groupBy(
        calendar.service_week(ts).alias("week"),
        calendar.service_week_number(ts).alias("week_number"),
    ).agg(F.count("*").alias("n_rows"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


@query
def iso_week_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(calendar.calendar_week(F.col("o_orderdate")).alias("monday")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


@query
def fri_thu_week_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(calendar.friday_week(F.col("o_orderdate")).alias("friday")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


@query
def local_day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times taken as UTC, counted per local day and local hour."""
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts").cast("timestamp_ntz")).cast("timestamp")
    return table(spark, sf_dir, "events").groupBy(
        calendar.local_day(utc).alias("local_day"), F.hour(calendar.local_wall_clock(utc)).alias("local_hour")
    ).agg(F.count("*").alias("n_rows"))


# Ranges and table maintenance


@query
def synthetic_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    keyed = rows.withColumn("key", jobs.TRIP_KEY.column(rows))
    return keyed.filter(ranges.in_window(F.col("key"), *WEEK)).select(
        "FECHA", "RUTA", "VEHICULO_REAL", "PARTIDA_REAL", "PARTIDA_PLANEADA", "key"
    )


@query
def window_guard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.window_stats(typed(spark, sf_dir), jobs.TRIP_KEY)


def _corrected(rows: DataFrame) -> DataFrame:
    """The window's rows as a later report would bring them."""
    inside = rows.filter(ranges.in_window(jobs.TRIP_KEY.column(rows), *WEEK))
    return inside.withColumn("PASAJERO", F.col("PASAJERO") + 1)


@query
def range_replace_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    return ranges.range_replaced(rows, _corrected(rows), jobs.TRIP_KEY, *WEEK)


@query
def range_replace_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table, with the replace run twice."""
    rows = materialize(typed(spark, sf_dir, bad_days=False), "typed")
    history = f"{scratch_schema(spark)}.trips"
    create_history(rows, history, jobs.TRIP_KEY)
    new = _corrected(rows)
    replace_range(new, history, jobs.TRIP_KEY, *WEEK)
    replace_range(new, history, jobs.TRIP_KEY, *WEEK)
    return spark.table(quoted(history)).drop(PARTITION_COLUMN)


@query
def readers_during_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of each day after a replace, and how many reads made meanwhile saw neither the old nor the new contents, or failed."""
    rows = materialize(typed(spark, sf_dir, bad_days=False), "typed")
    history = f"{scratch_schema(spark)}.trips"
    create_history(rows, history, jobs.TRIP_KEY)
    seen, done = [], threading.Event()

    def look() -> tuple:
        try:
            return tuple(spark.table(quoted(history)).agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first())
        except Exception as fault:  # noqa: BLE001 - counted
            return (str(fault),)

    def read() -> None:
        while not done.is_set():
            seen.append(look())

    before, reader = look(), threading.Thread(target=read, daemon=True)
    reader.start()
    try:
        replace_range(_corrected(rows), history, jobs.TRIP_KEY, *WEEK)
    finally:
        done.set()
        reader.join()
    odd = sum(s not in (before, look()) for s in set(seen))
    stored = spark.table(quoted(history))
    return stored.groupBy("FECHA").agg(F.count("*").alias("n_rows")).withColumn("odd_reads", F.lit(odd))


@query
def guarded_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled gaps rebuilt twice from a stored trip table by the SQL file."""
    ensure_time_type(spark)
    schema = scratch_schema(spark)
    rows = trips.typed_trips(raw_trips(spark, sf_dir, bad_days=False))
    create_history(rows, f"{schema}.trips", jobs.TRIP_KEY)
    for _ in range(2):
        rebuild_table(spark, jobs.SCHEDULED_GAPS_SQL, f"{schema}.trips", f"{schema}.gaps")
    return spark.table(quoted(f"{schema}.gaps"))


NEXT_WEEK = (WEEK[1], WEEK[1] + timedelta(weeks=1))


@query
def gaps_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled gaps of the whole history, brought up to it after each of two replaces that round planned departures to minutes."""
    rows = materialize(typed(spark, sf_dir, bad_days=False), "typed")
    schema = scratch_schema(spark)
    create_history(rows, f"{schema}.trips", jobs.TRIP_KEY)
    refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    for window in (WEEK, NEXT_WEEK):
        inside = rows.filter(ranges.in_window(jobs.TRIP_KEY.column(rows), *window))
        minute = F.concat(F.substring("PARTIDA_PLANEADA", 1, 6), F.lit("00"))
        replace_range(inside.withColumn("PARTIDA_PLANEADA", minute), f"{schema}.trips", jobs.TRIP_KEY, *window)
        refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    return spark.table(quoted(f"{schema}.gaps"))


def _weekly_run(spark: SparkSession, sf_dir: str, remove_outliers: bool) -> jobs.TripTables:
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    raw_trips(spark, sf_dir, bad_days=False).write.csv(
        f"{folder}/raw", sep=";", encoding="ISO-8859-1", header=True
    )
    schema = scratch_schema(spark)
    tables = jobs.TripTables(f"{schema}.trips", f"{schema}.headways", f"{schema}.gaps")
    jobs.run_trips(
        spark, f"{folder}/raw/*.csv", *MONTH, tables, f"{folder}/landed", remove_outliers
    )
    return tables


@query
def trips_job_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole trips job, from CSV files to the gap table, with the outlier model."""
    return spark.table(quoted(_weekly_run(spark, sf_dir, True).gaps))


@query
def trips_job_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report loaded, then corrected under the same name and loaded again: the correction is what is stored."""
    ensure_time_type(spark)
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    schema = scratch_schema(spark)
    tables = jobs.TripTables(f"{schema}.trips", f"{schema}.headways", f"{schema}.gaps")
    raw = raw_trips(spark, sf_dir, bad_days=False)
    for vehicle in (F.lit("1"), F.col("`Vehiculo real`")):
        _write_report(spark, raw.withColumn("Vehiculo real", vehicle), folder, "RV_month")
        jobs.run_trips(spark, f"{folder}/raw/RV_month*.csv", *MONTH, tables, f"{folder}/landed", remove_outliers=False)
    return spark.table(quoted(tables.trips)).drop(PARTITION_COLUMN)


def _put_under_one_name(spark: SparkSession, folder: str, name: str) -> None:
    """The one part file of a folder under a fixed name, in place of what was there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = path(name)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (part,) = [f.getPath() for f in fs.globStatus(path(f"{folder}/part-*.csv"))]
    _put(fs, part, target)


def _put(fs, part, target) -> None:
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    fs.rename(part, target)


def _write_report(spark: SparkSession, raw: DataFrame, folder: str, name: str) -> None:
    """The report as one file per task, under fixed names in ``raw``, the first one ``<name>.csv``; those of an earlier call are replaced."""
    new, path = f"{folder}/new-{uuid.uuid4().hex}", spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    raw.write.csv(new, sep=";", encoding="ISO-8859-1", header=True, ignoreLeadingWhiteSpace=False)
    fs = path(new).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in fs.globStatus(path(f"{new}/part-*.csv"))), key=lambda p: p.getName())
    for old in fs.globStatus(path(f"{folder}/raw/{name}_*.csv")) or []:
        fs.delete(old.getPath(), False)
    for number, part in enumerate(parts):
        _put(fs, part, path(f"{folder}/raw/{name}{f'_{number:05d}' if number else ''}.csv"))


@query
def landed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in two folders, with a column that has no header: all rows and columns are landed."""
    folder = f"{scratch_dir(spark)}/land-{uuid.uuid4().hex}"
    for number, day in enumerate(("a", "b")):
        rows = fleet_rows(spark, sf_dir).filter(F.col("Turno") == ("Matutino" if number else "Vespertino"))
        rows.select("Ruta", F.concat("Económico", F.lit("x")).alias(""), "Turno").coalesce(1).write.csv(
            f"{folder}/new{number}", sep=";", encoding="ISO-8859-1", header=True
        )
        _put_under_one_name(spark, f"{folder}/new{number}", f"{folder}/{day}/report.csv")
    for _ in range(2):
        land_report(spark, f"{folder}/[ab]/*.csv", "withdrawals", "2026-07-01", f"{folder}/landed")
    return landed(spark, f"{folder}/landed", "withdrawals").select("Ruta", "_c1", "Turno", "source_file")


@query
def stamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats of two text columns, one with the day first and one with the month first, and what they read by them."""
    ts = table(spark, sf_dir, "events").select("ts", "event_id")
    blank = F.col("event_id") % 50 == 0
    orders = {"day_first": "dd/MM/yyyy HH:mm:ss", "month_first": "MM/dd/yyyy HH:mm:ss"}
    texts = materialize(ts.select(*[F.when(blank, " ").otherwise(F.date_format("ts", f)).alias(n) for n, f in orders.items()]), "stamps")
    found = None
    for name in orders:
        inferred = inferred_format(texts, name)
        stamps = clock.report_stamp(F.col(name), (inferred,))
        read = texts.agg(F.count(stamps).alias("n_read"), F.min(stamps).alias("first"), F.max(stamps).alias("last"))
        rows = read.select(F.lit(name).alias("column"), F.lit(inferred).alias("format"), "n_read", "first", "last")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report whose quoted values hold line breaks, quotes and separators, written and read back in byte ranges."""
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    event_notes(spark, sf_dir).write.csv(
        folder, sep=";", encoding="ISO-8859-1", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return read_text_columns(spark, f"{folder}/*.csv", ";", "ISO-8859-1")


@query
def append_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends by name; rows with a column more are refused and leave the table as it was."""
    snapshot = fleet.fleet_snapshot(fleet_rows(spark, sf_dir))
    name = f"{scratch_schema(spark)}.fleet"
    append_table(snapshot, name)
    append_table(snapshot.select(*reversed(snapshot.columns)), name)
    refused = 0
    for odd in (snapshot.withColumn("more", F.lit(1)), snapshot.drop("ruta"), snapshot.withColumn("ruta", F.lit(1))):
        try:
            append_table(odd, name)
        except ValueError:
            refused += 1
    return spark.table(quoted(name)).groupBy("ruta", "turno").agg(
        F.count("*").alias("n_rows"), F.lit(refused).alias("refused")
    )


@query
def processed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips job's processed CSV, found under the name derived from the raw file."""
    ensure_time_type(spark)
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    schema = scratch_schema(spark)
    _write_report(spark, raw_trips(spark, sf_dir, bad_days=False), folder, "RV_sem01")
    tables = jobs.TripTables(f"{schema}.trips", f"{schema}.headways", f"{schema}.gaps")
    jobs.run_trips(
        spark, f"{folder}/raw/*.csv", *MONTH, tables, f"{folder}/landed", remove_outliers=False, line_breaks=False,
        out_root=f"{folder}/out",
    )
    return read_processed_csv(spark, f"{folder}/out/trips/trips_sem01", trip_schema())


@query
def fleet_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule extract stamped, read back and appended, twice."""
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    fleet_rows(spark, sf_dir).drop("Date", "Turno").write.csv(f"{folder}/raw", sep=";", header=True)
    jobs.run_stamp(spark, f"{folder}/raw/*.csv", f"{folder}/stamped", datetime(2026, 7, 1, 13))
    table_name = f"{scratch_schema(spark)}.fleet"
    for _ in range(2):
        jobs.run_fleet(spark, f"{folder}/stamped/*.csv", table_name)
    return spark.table(quoted(table_name))


@query
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per region; the expected one is taken, else the newest that fits the pattern."""
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    nation = table(spark, sf_dir, "nation")
    for number in range(3):
        nation.filter(F.col("n_regionkey") == number).coalesce(1).write.csv(f"{folder}/new{number}", sep=";", header=True)
        _put_under_one_name(spark, f"{folder}/new{number}", f"{folder}/in/Desinc_{number}.csv")
        time.sleep(1.1)  # file times may have whole seconds
    picked = None
    for wanted in ("Desinc_0.csv", "Desinc_none.csv"):
        path = expected_or_newest(spark, f"{folder}/in", wanted, "Desinc_*.csv")
        rows = read_text_columns(spark, path, ";", "UTF-8").select(F.lit(wanted).alias("wanted"), "n_name", "n_regionkey")
        picked = rows if picked is None else picked.unionByName(rows)
    return picked


def _one_file_per_value(spark: SparkSession, rows: DataFrame, column: str, folder: str, names: dict[str, str], encoding: str) -> list[str]:
    """CSV reports, one per value of ``column`` (which they do not hold) and all written at once; the paths, in the order of ``names``.
    A value's rows must come from one task."""
    new = f"{folder}/new"
    rows.write.partitionBy(column).csv(new, sep=";", encoding=encoding, header=True, escape='"')
    for value, name in names.items():
        _put_under_one_name(spark, f"{new}/{column}={value}", f"{folder}/in/{name}")
    return [f"{folder}/in/{name}" for name in names.values()]


@query
def newest_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in twelve reports, landed by expected name; the eighth report, the newest, stands for two that are not there."""
    folder = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 12).alias("report"))
    paths = _one_file_per_value(spark, events.repartition("report"), "report", folder, {str(n): f"Desinc_{n}.csv" for n in range(12)}, "UTF-8")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for number, path in enumerate(paths):
        at = 1_780_000_000_000 + 60_000 * (number if number != 7 else 99)
        hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(hadoop(path), at, -1)
    for number in range(14):
        jobs.run_landing(
            spark, f"{folder}/in", "operators", date(2026, 7, number + 1), f"{folder}/landed", line_breaks=False,
            expected=f"Desinc_{number}.csv", pattern="Desinc_*.csv",
        )
    rows = landed(spark, f"{folder}/landed", "operators", versions="all")
    return rows.groupBy("source_file", F.col("window_start").cast("string").alias("window_start"), "event_type").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum")
    )


@query
def guard_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which inputs the guard of the range replace refuses, and how many rows it lets through."""
    rows = materialize(typed(spark, sf_dir, bad_days=False), "typed")  # five guards read it
    inside = rows.filter(ranges.in_window(jobs.TRIP_KEY.strict_column(rows), *WEEK))
    cases = {
        "good": inside,
        "empty": inside.limit(0),
        "bad_dates": inside.withColumn("FECHA", F.when(F.col("RUTA") != "click", F.col("FECHA"))),
        "no_times": inside.withColumn("PARTIDA_REAL", F.lit(None).cast("string")),
        "outside": rows,
    }
    verdicts = []
    for name, case in cases.items():
        try:
            verdicts.append((name, False, ranges.check_window(case, jobs.TRIP_KEY, *WEEK)))
        except RuntimeError:
            verdicts.append((name, True, 0))
    return spark.createDataFrame(verdicts, "input string, refused boolean, n_rows bigint")


@query
def warehouse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report headers as column names, a byte-order mark on the first."""
    raw = raw_trips(spark, sf_dir)
    marked = raw.toDF("\ufeff" + raw.columns[0], *raw.columns[1:])
    named = with_warehouse_names(without_bom(marked))
    return named.groupBy("RUTA", "DESC_STATUS_DEL_VIAJE", "I_P_K").agg(
        *[F.count(c).alias(c) for c in ("FECHA", "ECONOMICO_PLANIFICADO", "VEL_PROMEDIO_KM", "TIEMP_PUNTO")]
    )


@query
def trips_job_headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole trips job without the outlier model: headway rows stored per week, route and state."""
    stored = spark.table(quoted(_weekly_run(spark, sf_dir, False).headways))
    return stored.groupBy(PARTITION_COLUMN, "RUTA", "ESTADO").agg(
        F.count("*").alias("n_rows"), F.sum(F.round(F.col("INTERVALO_MINUTOS") * 60).cast("bigint")).alias("gap_seconds")
    )


@query
def processed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip table written as processed CSV and loaded under the explicit schema."""
    ensure_time_type(spark)
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(trips.typed_trips(raw_trips(spark, sf_dir)), path)
    return read_processed_csv(spark, path, trip_schema())


@query
def landed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report landed twice unchanged; the second time nothing is added."""
    folder = f"{scratch_dir(spark)}/land-{uuid.uuid4().hex}"
    fleet_rows(spark, sf_dir).write.csv(f"{folder}/raw", sep=";", encoding="ISO-8859-1", header=True)
    for _ in range(2):
        land_report(spark, f"{folder}/raw/*.csv", "withdrawals", "2026-07-01", f"{folder}/landed")
    return landed(spark, f"{folder}/landed", "withdrawals").drop(
        "source_file", "source_path", "source_modified", "batch", "report"
    )


# Audit


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem, altered_lineitem(lineitem)


@query
def multiset_audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.multiset_summary(*_sides(spark, sf_dir))


@query
def audit_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables that differ on every month's first day: what is only on one side, and how many days were compared by row."""
    lineitem = table(spark, sf_dir, "lineitem")
    first = F.dayofmonth("l_shipdate") == 1
    changed = lineitem.withColumn("l_quantity", F.when(first, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    found = audit.narrowed(lineitem, changed, "l_shipdate")
    summary = audit.narrowed_summary(found)
    counts = {**summary, "n_days": found.parts, "n_differing": found.differing_parts}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@query
def multiset_audit_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole discrepancy report."""
    return audit.discrepancies(*_sides(spark, sf_dir))


@query
def dump_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discrepancies as the audit writes them to CSV, whole."""
    out = f"{scratch_dir(spark)}/dump-{uuid.uuid4().hex}"
    left, right = _sides(spark, sf_dir)
    report = audit_frames("lineitem", left, right, cutoff="1900-01-01", out_dir=out)
    rows = spark.read.csv(report.dump, header=True)
    return rows.groupBy("side", "l_returnflag").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("l_orderkey").cast("bigint")).alias("key_sum")
    )


@query
def multiset_audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All discrepancies, counted per side and quantity."""
    rows = audit.discrepancies(*_sides(spark, sf_dir), limit=None)
    return rows.groupBy("side", "l_quantity").agg(F.count("*").alias("n_rows"))


@query
def multiset_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash-free cross-check: what each side has more of."""
    extra = audit.multiset_difference(*_sides(spark, sf_dir))
    return extra.groupBy("side").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("key_sum"))


@query
def parity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema check, multiset summary and verdict for three pairs."""
    orders, customer = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    left, right = _sides(spark, sf_dir)
    renamed = [d.withColumnRenamed("l_shipdate", "FECHA") for d in (left, right)]
    pairs = {
        "same": (orders, orders.select(*reversed(orders.columns))),
        "altered": renamed,
        "other_schema": (orders, customer),
    }
    reports = [audit_frames(n, *sides, cutoff="1997-01-01") for n, sides in pairs.items()]
    rows = [
        (r.name, r.code, len(r.messages), *(r.summary.get(k) for k in
         ("matched_rows", "only_left_rows", "only_right_rows", "left_total", "right_total")))
        for r in reports
    ]
    return spark.createDataFrame(
        rows,
        "pair string, code int, n_messages int, matched_rows bigint, only_left_rows bigint, "
        "only_right_rows bigint, left_total bigint, right_total bigint",
    )


@query
def non_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    return audit.non_null_counts(rows, ["FECHA", "RUTA", "PARTIDA_REAL", "PARTIDA_PLANEADA", "LLEGADA_REAL"])


# Telemetry


@query
def can_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = F.concat(F.lit(" "), F.replace(F.col("`Can Data`"), F.lit("  "), F.lit(" \t\n ")), F.lit("   "))
    return can_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", squeezed(messy).alias("plain"))


@query
def can_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_can(branded_rows(can_rows(spark, sf_dir))).drop(PAIRS, "Fecha", "Empresa")


@query
def can_map_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_can(branded_rows(can_rows(spark, sf_dir)))
    entries = parsed.select("l_orderkey", "l_linenumber", "brand", F.explode(F.map_entries(PAIRS)).alias("e"))
    return entries.select("l_orderkey", "l_linenumber", "brand", "e.key", "e.value")


@query
def can_unit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = unit_profile(parse_can(branded_rows(can_rows(spark, sf_dir))))
    return profile.select("brand", "column", "n_values", "n_with_unit", "share", "unit", "generic")


@query
def can_wide_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows of all brands: parsed once, stored by brand, one select per layout."""
    parsed = materialize(parse_can(branded_rows(can_rows(spark, sf_dir))), "can-parsed", "brand")
    drop = {b.name: b.drop for b in BRANDS}
    wide = None
    for layout in layouts(parsed):
        for (brand,) in layout.slots:
            rows = can_wide(parsed.filter(F.col("brand") == brand), layout.profiles, drop[brand])
            rows = rows.withColumn("brand", F.lit(brand))
            wide = rows if wide is None else wide.unionByName(rows, allowMissingColumns=True)
    return wide


@query
def can_range_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry job over a range of days with one file per day and one day missing."""
    folder = f"{scratch_dir(spark)}/can-{uuid.uuid4().hex}"
    first = date(2025, 3, 1)  # file names have two digits for the year, so the days of 1995 are moved
    for offset in (0, 1, 3):
        day = first + timedelta(days=offset)
        moved = can_rows(spark, sf_dir).withColumn("Fecha", F.replace("Fecha", F.lit("/1995 "), F.lit("/2025 ")))
        rows = moved.filter(F.col("Fecha").startswith(f"{day:%d/%m/%Y}"))
        # One file per day, but the table is not read by one task for it.
        rows.repartition(1).write.csv(f"{folder}/new{offset}", sep=";", encoding="ISO-8859-1", header=True)
        _put_under_one_name(spark, f"{folder}/new{offset}", f"{folder}/in/{can_file(day)}")
    summary, skipped = jobs.run_can(spark, f"{folder}/in", first, first + timedelta(days=3), f"{folder}/out")
    return summary.withColumn("n_skipped", F.lit(len(skipped)))


@query
def can_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry job over all rows, dealt out to thirty days with one missing between them: what it reports and what it stored."""
    folder = f"{scratch_dir(spark)}/can-{uuid.uuid4().hex}"
    first = date(2025, 3, 1)
    days = [first + timedelta(days=n) for n in range(31) if n != 20]
    number = F.col("l_orderkey") % 30
    day = F.when(number < 20, number).otherwise(number + 1)
    rows = can_rows(spark, sf_dir, day).withColumn("day", day)
    names = {str((d - first).days): can_file(d) for d in days}
    _one_file_per_value(spark, rows, "day", folder, names, "ISO-8859-1")
    summary, skipped = jobs.run_can(spark, f"{folder}/in", first, days[-1], f"{folder}/out", line_breaks=False)
    stored = None
    for brand in BRANDS:
        out = f"{folder}/out/{brand.name.replace(' ', '_')}"
        if not path_exists(spark, out):  # a brand without a row
            continue
        wide = spark.read.option("mergeSchema", "true").parquet(out)
        found = wide.groupBy("report_day").agg(
            F.count("*").alias("n_stored"), F.sum(F.col("l_orderkey").cast("bigint")).alias("key_sum"), F.min("Fecha").cast("date").alias("first_date")
        ).withColumn("brand", F.lit(brand.name))
        stored = found if stored is None else stored.unionByName(found)
    return summary.join(stored, ["report_day", "brand"], "left").withColumn("n_skipped", F.lit(len(skipped)))


@query
def can_brand_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_counts(can_rows(spark, sf_dir))


@query
def fleet_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_snapshot(fleet_rows(spark, sf_dir))


@query
def fleet_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = fleet_rows(spark, sf_dir).drop("Date", "Turno")
    day = datetime(2026, 7, 1, 13)
    stamped = fleet.stamp_snapshot(extract, day.date(), shifts.clock_shift(F.lit(day.hour)))
    return fleet.fleet_snapshot(stamped)
