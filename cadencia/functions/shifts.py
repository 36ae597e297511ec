"""Shift and punctuality labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED_SHIFT = "nan"


def punctuality(minutes: Column) -> Column:
    """Within two minutes either way is on time; positive is early."""
    return (
        F.when(F.abs(minutes) <= 2, "En tiempo").when(minutes > 2, "Adelanta").otherwise("Retrasa")
    )


def departure_shift(hour: Column) -> Column:
    """Shift by departure hour; the hours up to 5 belong to none and are null."""
    return (
        F.when((hour > 5) & (hour <= 10), "Matutino")
        .when((hour > 10) & (hour <= 16), "Intermedio")
        .when((hour > 16) & (hour <= 24), "Vespertino")
    )


def clock_shift(hour: Column) -> Column:
    """Shift by the clock hour at which a snapshot is taken (other bounds than ``departure_shift``)."""
    return (
        F.when((hour >= 4) & (hour < 12), "Matutino")
        .when((hour >= 12) | (hour == 0), "Vespertino")
        .otherwise("Ninguno")
    )
