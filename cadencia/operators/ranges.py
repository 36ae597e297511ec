"""Ranges over the trip instant: key, half-open filter, guards."""

from __future__ import annotations

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadencia.functions import clock

DATE_TYPES = ("TIMESTAMP", "DATETIME", "DATE")


class RangeKey(NamedTuple):
    """Columns that place a row in time; the date column alone is always midnight."""

    date: str
    time: str
    fallback: str | None = None

    def column(self, df: DataFrame) -> Column:
        """Date plus the first known time of day, midnight if none is known."""
        times = [clock.seconds_of_day(df, c) for c in (self.time, self.fallback) if c]
        return clock.instant(df[self.date], F.coalesce(*times, F.lit(0)))

    def strict_column(self, df: DataFrame) -> Column:
        """Date plus the main time of day; null if that is missing."""
        return clock.instant(df[self.date], clock.seconds_of_day(df, self.time))


def check_window_arguments(start: datetime, end: datetime, date_type: str = "TIMESTAMP") -> None:
    if date_type not in DATE_TYPES:
        raise ValueError(f"date type {date_type!r} is not one of {DATE_TYPES}")
    if end <= start:
        raise ValueError(f"the window is empty: {start} .. {end}")


def in_window(key: Column, start: datetime, end: datetime) -> Column:
    low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end))
    return (key >= low) & (key < high)


def date_filter(df: DataFrame, cutoff: str, until: str | None = None, column: str = "FECHA") -> DataFrame:
    """Rows from ``cutoff`` up to but without ``until``; the whole table if it lacks the column.

    The literal takes the column's own type, so the predicate reaches the Parquet scan.
    """
    named = {c.upper(): c for c in df.columns}
    if column.upper() not in named:
        return df
    name = named[column.upper()]
    kind = df.schema[name].dataType.simpleString()
    if kind not in ("date", "timestamp", "timestamp_ntz"):
        raise ValueError(f"{name} is {kind}, not a date or timestamp")
    kept = df.filter(F.col(name) >= F.lit(cutoff).cast(kind))
    return kept.filter(F.col(name) < F.lit(until).cast(kind)) if until else kept


def window_stats(df: DataFrame, key: RangeKey) -> DataFrame:
    """One row: extent of the key, and how many rows lack a date or a time. Lazy."""
    strict = key.strict_column(df)
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(df[key.date].isNull()).alias("bad_dates"),
        F.count_if(clock.seconds_of_day(df, key.time).isNull()).alias("null_times"),
        F.min(strict).alias("min_key"),
        F.max(strict).alias("max_key"),
    )


def check_window(df: DataFrame, key: RangeKey, start: datetime, end: datetime) -> int:
    """Refuse rows outside the window before anything is replaced; returns the row count. An action.

    Rows without a main time say nothing about the window and are ignored.
    """
    stats = window_stats(df, key).first()
    if stats.total_rows == 0:
        raise RuntimeError("no rows to load: replacing the window would leave a hole")
    if stats.bad_dates:
        raise RuntimeError(f"{stats.bad_dates} rows have no readable {key.date}")
    if stats.null_times == stats.total_rows:
        raise RuntimeError(f"no row has {key.time}; the window cannot be checked")
    if stats.min_key < start or stats.max_key >= end:
        raise RuntimeError(
            f"rows span {stats.min_key} .. {stats.max_key}, outside {start} .. {end}"
        )
    return stats.total_rows


def count_between_days(df: DataFrame, column: str, first: date, last: date) -> int:
    """Rows whose date lies between two days, both included; a cross-check of the key range."""
    day = F.col(column).cast("date")
    return df.filter(day.between(F.lit(first), F.lit(last))).count()


def range_replaced(
    old: DataFrame, new: DataFrame, key: RangeKey, start: datetime, end: datetime
) -> DataFrame:
    """The table after the replace: old rows outside ``[start, end)``, plus all new rows."""
    outside = ~F.coalesce(in_window(key.column(old), start, end), F.lit(False))
    return old.filter(outside).unionByName(new)
