"""Fleet snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadencia.functions import clock, numbers
from cadencia.operators.trips import require_headers
from cadencia.schemas import FLEET_COLUMNS


def stamp_snapshot(raw: DataFrame, day: date, shift: str | Column) -> DataFrame:
    """Put the snapshot's date (``yyyyMMdd``) and shift in front of the extract."""
    label = F.lit(shift) if isinstance(shift, str) else shift
    rest = [F.col(f"`{c}`") for c in raw.columns]
    return raw.select(F.lit(f"{day:%Y%m%d}").alias("Date"), label.alias("Turno"), *rest)


def fleet_snapshot(raw: DataFrame) -> DataFrame:
    """Typed snapshot under table names; columns it does not know pass through."""
    require_headers(raw, list(FLEET_COLUMNS))
    return raw.withColumns(
        {
            "Date": clock.strict_compact_day(F.col("Date")),
            "Jornada": numbers.whole_or_null(F.col("Jornada")),
        }
    ).withColumnsRenamed(FLEET_COLUMNS)
