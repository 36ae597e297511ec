"""Trip report: typed trip table, and headways with punctuality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadencia.functions import clock, numbers, shifts
from cadencia.schemas import TRIP_FIELDS
from cadencia.session import ensure_time_type

_HEADER = {f.name: f.header for f in TRIP_FIELDS}


def _raw(name: str) -> Column:
    return F.col(f"`{_HEADER[name]}`")


def require_headers(df: DataFrame, headers: list[str]) -> None:
    missing = sorted(set(headers) - set(df.columns))
    if missing:
        raise ValueError(f"report lacks the columns {missing}")


def typed_trips(raw: DataFrame, clock_as: str = "time") -> DataFrame:
    """The 24-column trip table: all statuses, no deduplication, difference columns left as text.

    ``clock_as``: ``"time"`` for TIME columns, ``"text"`` for ``HH:mm:ss`` (CSV has no TIME).
    """
    require_headers(raw, [f.header for f in TRIP_FIELDS])
    if clock_as == "time":
        ensure_time_type(raw.sparkSession)
        as_clock = lambda c: clock.time_of_day(clock.clock_seconds(c))
    else:
        as_clock = clock.plain_clock
    typed = {
        "day": lambda c: clock.midnight(clock.report_day(c)),
        "clock": as_clock,
        "whole": numbers.whole_or_zero,
        "real": numbers.real_or_zero,
        "text": lambda c: c.cast("string"),
    }
    return raw.select(*[typed[f.kind](F.col(f"`{f.header}`")).alias(f.name) for f in TRIP_FIELDS])


def performed_trips(raw: DataFrame) -> DataFrame:
    """Trips that ran (status 1)."""
    return raw.filter(numbers.number(_raw("STATUS_DEL_VIAJE")) == 1)


def next_departures(departures: DataFrame, keys: list[str], second: str, order_key: str) -> DataFrame:
    """Add ``next_second``: the next departure of the same keys, null after the last one.

    Departures are first reduced to distinct instants. A group then has at most one row per second
    of a day, so the window below is bounded however many rows share the keys. Of the rows at one
    instant, the one with the largest ``order_key`` is last and sees the next instant; the others
    see their own. ``order_key`` must be a bigint that differs between different rows. Copies of
    the same row do not disturb the instants, so ``departures`` may still hold them.
    """
    at = [*keys, second]
    instants = departures.groupBy(*at).agg(F.max(order_key).alias("_last"))
    following = instants.withColumn(
        "_following", F.lead(second).over(Window.partitionBy(*keys).orderBy(second))
    )
    return following.select(*at, "_last", "_following")


def headways(
    raw: DataFrame, unmapped_shift: str = "keep", order_key: Column | None = None
) -> DataFrame:
    """Minutes to the next departure of the route on the same day, with punctuality and shift.

    ``unmapped_shift``: departures before 06:00 have no shift; ``"keep"`` labels them ``nan``,
    ``"drop"`` removes them. ``order_key`` decides which of several departures at the same second
    counts as the last; by default a hash of the whole row.
    """
    needed = ["FECHA", "RUTA", "VEHICULO_REAL", "PARTIDA_REAL", "DIFF_PARTIDA", "STATUS_DEL_VIAJE"]
    require_headers(raw, [_HEADER[n] for n in needed])
    columns = [F.col(f"`{c}`") for c in raw.columns]
    if order_key is None:
        # Missing values are marked, or ('a', null) and (null, 'a') would hash alike.
        order_key = F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns])

    def placed(df: DataFrame) -> DataFrame:
        return df.select(
            clock.report_day(_raw("FECHA")).alias("day"),
            _raw("RUTA").cast("string").alias("route"),
            clock.clock_seconds(_raw("PARTIDA_REAL")).alias("second"),
            order_key.cast("bigint").alias("order_key"),
            numbers.number(_raw("VEHICULO_REAL")).alias("vehicle"),
            numbers.signed_minutes(_raw("DIFF_PARTIDA"), dash_is_early=True).alias("early"),
        ).filter("day IS NOT NULL AND route IS NOT NULL AND second IS NOT NULL")

    ran = performed_trips(raw)
    # Trips without a vehicle still take part as departures; they only leave the result.
    following = next_departures(placed(ran), ["day", "route"], "second", "order_key")
    rows = placed(ran.dropDuplicates()).filter("vehicle IS NOT NULL")
    joined = (
        rows.join(following, ["day", "route", "second"])
        .withColumn(
            "next_second",
            F.when(F.col("order_key") == F.col("_last"), F.col("_following")).otherwise(F.col("second")),
        )
        .filter("next_second IS NOT NULL")
    )
    day, second, following_second = F.col("day"), F.col("second"), F.col("next_second")
    gap = following_second - second
    shift = shifts.departure_shift(clock.hour_of(second))
    if unmapped_shift == "drop":
        joined = joined.filter(shift.isNotNull())
    return joined.select(
        clock.midnight(day).alias("FECHA"),
        F.col("route").alias("RUTA"),
        F.col("vehicle").alias("ECONOMICO"),
        clock.instant(F.lit(clock.DUMMY_DAY), second).alias("PARTIDA_REAL"),
        shifts.punctuality(F.col("early")).alias("ESTADO"),
        F.col("early").alias("DIFF_PARTIDA"),
        clock.instant(day, second).alias("TIMESTAMP_SALIDA"),
        clock.instant(day, following_second).alias("SALIDA_SIGUIENTE"),
        clock.gap_text(gap).alias("INTERVALO"),
        clock.gap_minutes(gap).alias("INTERVALO_MINUTOS"),
        clock.weekday(day).alias("DIA_DE_LA_SEMANA"),
        F.coalesce(shift, F.lit(shifts.UNMAPPED_SHIFT)).alias("TURNO"),
        clock.hour_of(second).alias("FRANJA_HORARIA"),
    )
