"""Scheduled gaps: half the largest planned gap per date, route and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadencia.functions import clock


def scheduled_gaps(
    trips: DataFrame, date: str = "FECHA", route: str = "RUTA", planned: str = "PARTIDA_PLANEADA"
) -> DataFrame:
    """One row per date, route and hour in which a departure follows an earlier one of that day.

    Planned departures are counted per second first, so the window holds at most one row per second
    of the day for a date and route, however many trips share them. Two departures planned for the
    same second are a gap of zero.
    """
    instants = (
        trips.select(
            F.col(date).cast("date").alias("FECHA"),
            F.col(route).alias("RUTA"),
            clock.seconds_of_day(trips, planned).alias("second"),
        )
        .filter("second IS NOT NULL AND FECHA IS NOT NULL")
        .groupBy("FECHA", "RUTA", "second")
        .agg(F.count("*").alias("departures"))
    )
    day = Window.partitionBy("FECHA", "RUTA").orderBy("second")
    gap = F.greatest(
        F.col("second") - F.lag("second").over(day), F.when(F.col("departures") > 1, 0)
    )
    return (
        instants.select("FECHA", "RUTA", clock.hour_of(F.col("second")).alias("HORA"), gap.alias("gap"))
        .filter("gap IS NOT NULL")
        .groupBy("FECHA", "RUTA", "HORA")
        .agg((F.max("gap") / F.lit(2.0)).alias("INTERVALO_SEC"))
    )
