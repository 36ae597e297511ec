"""Scheduled gaps rebuilt where trips changed.

A date's gaps on a route depend on that date's and route's planned departures alone. Beside each version of the gap table lies
a ledger: for every service week of the trip history the folder its files were in, and a fingerprint of the planned
departures of each (date, route) in it. A later run reads only the weeks whose folder is another one, finds the groups whose
fingerprints differ, and recomputes those.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.functions import clock
from cadencia.operators.prints import COUNT, PRINTS, changed_groups, fingerprint
from cadencia.operators.schedule import scheduled_gaps
from cadencia.plans.store import NO_WEEK, put_version, week_folders
from cadencia.plans.versions import checked_name, current, data_folder, locked, quoted
from cadencia.schemas import PARTITION_COLUMN
from cadencia.session import materialize, path_exists

LEDGER = "ledger"
_GROUP = ("day", "route")
_LEDGER_SCHEMA = ", ".join(["week string, folder string, day date, route string", *[f"{c} bigint" for c in (COUNT, *PRINTS)]])


class Refreshed(NamedTuple):
    rows: int
    weeks_read: int
    weeks: int
    groups_rebuilt: int


def _week_text() -> Column:
    return F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_WEEK))


def _departures(trips: DataFrame) -> DataFrame:
    """Week, date, route and planned second of every trip, those without a plan included."""
    return trips.select(
        _week_text().alias("week"), F.col("FECHA").cast("date").alias("day"), F.col("RUTA").alias("route"),
        clock.seconds_of_day(trips, "PARTIDA_PLANEADA").alias("second"),
    )


def _of_weeks(trips: DataFrame, weeks: list[str]) -> DataFrame:
    """The rows of these weeks; the predicate is on the partition column, so that other weeks are not read."""
    dated = [w for w in weeks if w != NO_WEEK]
    kept = F.col(PARTITION_COLUMN).isin(*[F.lit(w).cast("date") for w in dated]) if dated else F.lit(False)
    return trips.filter(kept | F.col(PARTITION_COLUMN).isNull() if NO_WEEK in weeks else kept)


def _same_group(left: DataFrame, right: DataFrame, day: str, route: str) -> Column:
    return left[day].eqNullSafe(right["day"]) & left[route].eqNullSafe(right["route"])


def refresh_gaps(spark: SparkSession, trips: str, gaps: str, min_row_ratio: float = 0.9) -> Refreshed:
    """Bring the gap table ``gaps`` up to the trip history ``trips``; the result is that of a rebuild over the whole history.

    A gap table without a ledger (none, or one of a full rebuild) is computed whole. Rows, ledger and the folders it speaks of
    are published in one statement, so a run that dies leaves the version before, with the ledger that fits it. The guard
    is that of the full rebuild: a table without rows, or with fewer than ``min_row_ratio`` of those before, is refused. A
    history that changed nowhere publishes nothing.

    Ledger and gap table have one row per group and per group and hour, however many trips there are; both are rewritten
    by a run that finds a change.
    """
    checked_name(gaps, "gaps")
    source = current(spark, checked_name(trips, "trips"))
    if source is None:
        raise ValueError(f"{trips} is no versioned history")
    # The version itself, not the view: a replace that runs meanwhile publishes another.
    stored, folders = spark.table(quoted(source)), week_folders(spark, source)
    with locked(spark, gaps):
        old = current(spark, gaps)
        place = f"{data_folder(spark, gaps)}/{old}/_beside/{LEDGER}"
        known = old is not None and path_exists(spark, place)
        ledger = spark.read.schema(_LEDGER_SCHEMA).parquet(place) if known else spark.createDataFrame([], _LEDGER_SCHEMA)
        seen = {r.week: r.folder for r in ledger.select("week", "folder").distinct().collect()}
        changed = sorted(w for w in seen.keys() | folders.keys() if seen.get(w) != folders.get(w))
        if known and not changed:
            return Refreshed(spark.table(quoted(gaps)).count(), 0, len(folders), 0)
        present = [w for w in changed if w in folders]
        named = spark.createDataFrame([(w, folders[w]) for w in present], "week string, folder string")
        prints = fingerprint(_departures(_of_weeks(stored, present)), ["week", *_GROUP], ["second"])
        fresh = materialize(prints.join(named, "week"), "gap-prints").select(*ledger.columns)
        touched = F.col("week").isin(changed)
        groups = changed_groups(ledger.filter(touched), fresh, ["week", *_GROUP]).select(*_GROUP).distinct()
        groups = materialize(groups, "gap-groups")
        now = ledger.filter(~touched).unionByName(fresh)
        if known:
            before = spark.table(quoted(gaps))
            # A date's first hours belong to the week before, so a group may also lie in weeks that did not change.
            holding = now.join(groups, _same_group(now, groups, "day", "route"), "left_semi")
            rows = _of_weeks(stored, [r.week for r in holding.select("week").distinct().collect()])
            rows = rows.withColumn("_day", F.col("FECHA").cast("date"))
            new = scheduled_gaps(rows.join(groups, _same_group(rows, groups, "_day", "RUTA"), "left_semi"))
            kept = before.join(groups, _same_group(before, groups, "FECHA", "RUTA"), "left_anti")
            new = kept.unionByName(new.select(*[F.col(f.name).cast(f.dataType) for f in before.schema]))
        else:
            new = scheduled_gaps(stored)
        n = put_version(spark, gaps, new, min_row_ratio, {LEDGER: now})
        return Refreshed(n, len(present), len(folders), groups.count())
