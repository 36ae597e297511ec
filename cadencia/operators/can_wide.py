"""Telemetry pairs to columns: key discovery, unit profile, unit stripping."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.functions import clock
from cadencia.functions.numbers import number
from cadencia.session import materialize
from cadencia.operators.can_text import BRAND, FIELDS, NUMERIC_FIELDS, PAIRS

# Fixed value: a number with its unit.
_WITH_UNIT = r"^([-+]?[0-9]+(?:\.[0-9]+)?)(?U:\s*)([%°a-zA-Z/]+)$"
UNIT_SHARE = 0.8
STAMP = "Fecha"
_RESERVED = ("Fecha", "Hora", "brand")


class Profile(NamedTuple):
    """What is known about one output column."""

    column: str
    generic: bool = False  # occurs as a key in the text
    unit: str | None = None  # unit to strip; None leaves the column as it is


class Layout(NamedTuple):
    """Slots (e.g. days of a brand) whose output has the same columns."""

    slots: list[tuple]
    profiles: list[Profile]


def _passed_through(parsed: DataFrame) -> list[str]:
    own = {*FIELDS, BRAND, PAIRS, "brand", STAMP}
    return [c for c in parsed.columns if c not in own]


def _effective(parsed: DataFrame, name: str) -> Column:
    """Text of a fixed field; a key of the same name in the text wins."""
    own = parsed[name].cast("string")
    return F.coalesce(F.try_element_at(PAIRS, F.lit(name)), own)


def unit_profile(parsed: DataFrame, by: Sequence[str] = ("brand",)) -> DataFrame:
    """Per slot and column: values, values with a unit, share, most frequent unit (ties: smallest).

    All columns of all slots in one pass: the values go into long form and are counted per unit
    before the shuffle, so what is shuffled grows with the number of distinct units, not of rows.
    """
    fixed = [BRAND, *FIELDS]
    texts = [c for c in _passed_through(parsed) if parsed.schema[c].dataType == T.StringType()]
    cell = lambda name, value: F.struct(
        name.alias("column"), value.alias("value")
    )
    named = [cell(F.lit(c), _effective(parsed, c)) for c in fixed]
    named += [cell(F.lit(c), F.col(f"`{c}`")) for c in texts]
    generic = F.filter(F.map_entries(PAIRS), lambda e: ~e.key.isin(*fixed))
    cells = F.concat(
        F.filter(F.array(*named), lambda c: c.value.isNotNull()),
        F.transform(generic, lambda e: cell(output_name(e.key, texts), e.value)),
    )
    exploded = parsed.select(*by, F.explode(cells).alias("c"), F.map_keys(PAIRS).alias("keys"))
    unit = F.regexp_extract("c.value", _WITH_UNIT, 2)
    per_unit = (
        exploded.select(
            *by,
            F.col("c.column").alias("column"),
            F.when(unit != "", unit).alias("unit"),
            # Keys that take another output name are generic anyway; see ``output_name``.
            (F.array_contains("keys", F.col("c.column")) | ~F.col("c.column").isin(*fixed, *texts))
            .cast("int")
            .alias("generic"),
        )
        .groupBy(*by, "column", "unit")
        .agg(F.count("*").alias("n"), F.max("generic").alias("generic"))
    )
    rank = F.when(F.col("unit").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("unit")))
    matched = F.sum(F.when(F.col("unit").isNotNull(), F.col("n")).otherwise(0))
    return per_unit.groupBy(*by, "column").agg(
        F.sum("n").alias("n_values"),
        matched.alias("n_with_unit"),
        (matched / F.sum("n")).alias("share"),
        F.min(rank)["unit"].alias("unit"),
        (F.max("generic") == 1).alias("generic"),
    )


def output_name(key: Column, taken: Sequence[str]) -> Column:
    """A key named like a raw column gets the prefix ``can_``."""
    return F.when(key.isin(*taken, *_RESERVED), F.concat(F.lit("can_"), key)).otherwise(key)


def layouts(parsed: DataFrame, by: Sequence[str] = ("brand",)) -> list[Layout]:
    """Column layouts of all slots, equal ones together. An action.

    The layout is what a wide table's schema is, so it comes to the driver. A feed whose keys are values
    gives a schema that no table can take: the long form, ``can_long``, holds such a feed whole, and
    ``can_wide`` then gets the profiles of the columns that are wanted.
    """
    profile = materialize(unit_profile(parsed, by), "can-profile")
    column = F.struct(
        "column", "generic", F.when(F.col("share") > UNIT_SHARE, F.col("unit")).alias("unit")
    )
    per_slot = profile.groupBy(*by).agg(F.sort_array(F.collect_list(column)).alias("columns"))
    grouped = per_slot.groupBy("columns").agg(F.sort_array(F.collect_list(F.struct(*by))).alias("slots"))
    return [
        Layout([tuple(s) for s in row["slots"]], [Profile(*c) for c in row["columns"]])
        for row in grouped.collect()
    ]


def can_long(parsed: DataFrame, keys: Sequence[str], by: Sequence[str] = ("brand",)) -> DataFrame:
    """The complete result without a limit on columns: one row per ``keys``, slot, column and value as text."""
    texts = [c for c in _passed_through(parsed) if parsed.schema[c].dataType == T.StringType() and c not in (*keys, *by)]
    cell = lambda name, value: F.struct(name.alias("column"), value.alias("value"))
    named = [cell(F.lit(c), _effective(parsed, c)) for c in (BRAND, *FIELDS)]
    named += [cell(F.lit(c), F.col(f"`{c}`")) for c in texts]
    generic = F.filter(F.map_entries(PAIRS), lambda e: ~e.key.isin(BRAND, *FIELDS))
    cells = F.concat(
        F.filter(F.array(*named), lambda c: c.value.isNotNull()),
        F.transform(generic, lambda e: cell(output_name(e.key, texts), e.value)),
    )
    return parsed.select(*by, *keys, F.explode(cells).alias("c")).select(*by, *keys, "c.column", "c.value")


def _column(parsed: DataFrame, profile: Profile) -> Column:
    name = profile.column
    if name in _passed_through(parsed):
        value = F.col(f"`{name}`")
        if parsed.schema[name].dataType != T.StringType():
            return value.alias(name)
    elif name in NUMERIC_FIELDS and not profile.generic:
        return F.col(name)
    elif name in FIELDS or name == BRAND:
        value = _effective(parsed, name)
    else:
        taken = {f"can_{c}" for c in (*_passed_through(parsed), *_RESERVED)}
        key = name.removeprefix("can_") if name in taken else name
        value = F.coalesce(
            *[F.try_element_at(PAIRS, F.lit(k)) for k in dict.fromkeys((key, name))]
        )
    if profile.unit is None:
        return value.alias(name)
    digits = number(F.regexp_extract(value, _WITH_UNIT, 1))
    return F.bround(digits).cast("bigint").alias(f"{name.strip()} ({profile.unit})")


def can_wide(
    parsed: DataFrame,
    profiles: Sequence[Profile],
    drop: Sequence[str] = (),
    formats: Sequence[str] = clock.STAMP_FORMATS,
    clock_as: str = "text",
    unreadable: str = "fail",
) -> DataFrame:
    """Wide table of one layout's rows: ``Fecha``, ``Hora``, raw columns, fixed fields, keys by name.

    Text columns in which more than 80 % of the values are a number with a unit become whole numbers
    (halves to even, other values null) and carry the unit in their name. ``drop`` names columns as
    they are called then.
    """
    known = {p.column: p for p in profiles}
    passed = [c for c in _passed_through(parsed)]
    order = passed + [c for c in (BRAND, *FIELDS) if c in known]
    order += sorted(known.keys() - set(order))
    columns = [_column(parsed, known.get(c, Profile(c))) for c in order]
    stamps = []
    if STAMP in parsed.columns:
        stamp = parsed[STAMP]
        if isinstance(parsed.schema[STAMP].dataType, T.StringType):
            stamp = clock.report_stamp(stamp, formats, unreadable)
        seconds = (F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)).cast("int")
        hour = clock.clock_text(seconds) if clock_as == "text" else clock.time_of_day(seconds)
        stamps = [clock.midnight(stamp).alias(STAMP), F.when(stamp.isNotNull(), hour).alias("Hora")]
    wide = parsed.select(*stamps, *columns)
    names = [n for n in wide.columns if n not in drop]
    if len(set(names)) < len(names):
        raise RuntimeError(f"unit stripping made equal column names: {sorted(names)}")
    return wide.select(*[F.col(f"`{n}`") for n in names])
