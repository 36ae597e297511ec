"""Numbers read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast also takes '1d' and '2f'; the reports' reader does not.
_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
_SIGNED_CLOCK = r"(\d+):(\d+):(\d+)"


def number(col: Column) -> Column:
    """Text to double; anything that is not a number is null."""
    text = col.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def whole_or_zero(col: Column) -> Column:
    """Number cut towards zero; missing or unreadable is 0."""
    return F.coalesce(number(col).try_cast("bigint"), F.lit(0).cast("bigint"))


def real_or_zero(col: Column) -> Column:
    return F.coalesce(number(col), F.lit(0.0))


def whole_or_null(col: Column) -> Column:
    """Number as bigint keeping nulls; a fractional value is an error, not a silent cut."""
    value = number(col)
    fractional = F.raise_error(F.concat(F.lit("not a whole number: "), col.cast("string")))
    return F.when(value == F.floor(value), value.cast("bigint")).when(
        value.isNotNull(), fractional.cast("bigint")
    )


def signed_minutes(col: Column, dash_is_early: bool) -> Column:
    """``[-]HH:MM:SS`` to minutes; unreadable is 0.

    ``dash_is_early``: a leading ``-`` means ahead of plan and becomes positive, everything else
    negative. Otherwise the natural sign. Only the very first character decides.
    """
    part = [
        F.coalesce(F.regexp_extract(col, _SIGNED_CLOCK, i).try_cast("bigint"), F.lit(0))
        for i in (1, 2, 3)
    ]
    minutes = part[0] * 60 + part[1] + part[2] / F.lit(60.0)
    dashed = F.coalesce(col.startswith("-"), F.lit(False))
    sign = F.when(dashed if dash_is_early else ~dashed, 1.0).otherwise(-1.0)
    # Adding 0.0 turns a negative zero into zero.
    return sign * minutes + F.lit(0.0)
