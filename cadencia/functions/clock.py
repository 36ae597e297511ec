"""Dates, times of day and differences, all as local wall clock without zone.

A time of day is handled as whole seconds since midnight (INT), whatever type it is stored in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_DAY_TEXT = r"^\d{1,2}/\d{1,2}/\d{4}$"
_CLOCK_TEXT = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"
_FULL_CLOCK_TEXT = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d\z"

# Formats accepted for telemetry stamps, tried in this order. Days come before months: 01/07/2026 is 1 July.
STAMP_FORMATS = (
    "d/M/yyyy H:m:s[.SSSSSS]", "d/M/yyyy H:m", "yyyy-M-d H:m:s[.SSSSSS]", "yyyy-M-d'T'H:m:s[.SSSSSS]", "d/M/yyyy", "yyyy-M-d",
)

DUMMY_DAY = "1900-01-01"


def report_day(col: Column) -> Column:
    """``dd/MM/yyyy`` to date; anything else is null."""
    return F.when(col.rlike(_DAY_TEXT), F.try_to_date(col, "d/M/yyyy"))


def clock_seconds(col: Column) -> Column:
    """``HH:mm:ss`` text to seconds since midnight; ``-``, ``24:00:00`` and the like are null."""

    part = [F.split_part(col, F.lit(":"), F.lit(i)).cast("int") for i in (1, 2, 3)]
    return F.when(col.rlike(_CLOCK_TEXT), part[0] * 3600 + part[1] * 60 + part[2])


def plain_clock(col: Column) -> Column:
    """``H:m:s`` text as ``HH:mm:ss``; null where ``clock_seconds`` is null. Most texts are written so already."""
    part = [F.lpad(F.btrim(F.split_part(col, F.lit(":"), F.lit(i)), F.lit("\r\n")), 2, "0") for i in (1, 2, 3)]
    return F.when(col.rlike(_FULL_CLOCK_TEXT), col).when(col.rlike(_CLOCK_TEXT), F.concat_ws(":", *part))


def seconds_of_day(df: DataFrame, name: str) -> Column:
    """Seconds since midnight of a TIME, timestamp or ``HH:mm:ss`` text column."""
    col, kind = df[name], df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return clock_seconds(col)
    if isinstance(kind, T.TimeType):
        return F.call_function("time_diff", F.lit("SECOND"), F.expr("TIME '00:00:00'"), col).cast("int")
    return (F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)).cast("int")


# The next functions name their argument once: an expression that repeats its input grows with every
# layer the optimizer folds into it.


def _interval(seconds: Column) -> Column:
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def clock_text(seconds: Column) -> Column:
    """Seconds since midnight to ``HH:mm:ss``, cut out of ``INTERVAL '0 HH:mm:ss' DAY TO SECOND``."""
    return F.substring(_interval(seconds).cast("string"), 13, 8)


def time_of_day(seconds: Column) -> Column:
    """Seconds since midnight to TIME."""
    return F.expr("TIME '00:00:00'") + _interval(seconds)


def midnight(day: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz")


def instant(day: Column, seconds: Column) -> Column:
    """Date and seconds since midnight to one wall-clock timestamp."""
    return midnight(day) + _interval(seconds)


def stamp_text(stamp: Column) -> Column:
    """Timestamp as text; a missing stamp stays null."""
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def strict_compact_day(col: Column) -> Column:
    """``yyyyMMdd`` to a midnight timestamp; a bad value is an error."""
    text = col.cast("string")
    bad = F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), text))
    parsed = F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
    checked = F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(bad.cast("date"))
    return checked.cast("timestamp_ntz")


def report_stamp(col: Column, formats: Sequence[str] = STAMP_FORMATS, unreadable: str = "fail") -> Column:
    """Timestamp text in one of the declared formats.

    Other text is an error that names it, or null with ``unreadable="null"``; ``unreadable_stamps`` counts it.
    """
    if unreadable not in ("fail", "null"):
        raise ValueError(f"unreadable must be 'fail' or 'null', not {unreadable!r}")
    # ``try_to_timestamp`` yields a zoned value; the session zone cancels out in the cast back.
    tried = [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats]
    if unreadable == "fail":
        bad = F.raise_error(F.concat(F.lit("unreadable time stamp: "), col)).cast("timestamp_ntz")
        tried.append(F.when(F.trim(col) != "", bad))
    return F.coalesce(*tried)


def unreadable_stamps(col: Column, formats: Sequence[str] = STAMP_FORMATS) -> Column:
    """Aggregate: how many texts no format reads; blank texts are missing, not unreadable."""
    return F.count_if((F.trim(col) != "") & report_stamp(col, formats, unreadable="null").isNull())


def day_tag(day: Column) -> Column:
    return F.date_format(day, "ddMMyy")


def whole_seconds_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)


def gap_minutes(seconds: Column) -> Column:
    return seconds / F.lit(60.0)


def gap_text(seconds: Column) -> Column:
    """``0 days 00:12:30``"""
    return F.concat(
        F.floor(seconds / 86400).cast("string"), F.lit(" days "), clock_text(seconds % 86400)
    )


def weekday(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day).cast("bigint")


def hour_of(seconds: Column) -> Column:
    return F.floor(seconds / 3600).cast("bigint")
