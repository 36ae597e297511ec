"""Operational calendar: job windows as parameters, the same weeks as columns.

The service week runs from Monday 03:20 to the next Monday 03:20, half open.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Mexico_City"
WEEK = timedelta(days=7)
SERVICE_START = time(3, 20)
_SERVICE_SHIFT = "INTERVAL '03:20:00' HOUR TO SECOND"


def wall_clock(now: datetime | None = None) -> datetime:
    """Local wall clock without zone; a naive ``now`` is taken as local already."""
    if now is None:
        now = datetime.now(ZoneInfo(ZONE))
    return now if now.tzinfo is None else now.astimezone(ZoneInfo(ZONE)).replace(tzinfo=None)


def last_service_week(now: datetime | None = None) -> tuple[datetime, datetime]:
    """Last closed service week; at exactly Monday 03:20 the week has closed."""
    here = wall_clock(now)
    monday = (here - timedelta(days=here.weekday())).date()
    end = datetime.combine(monday, SERVICE_START)
    if here < end:
        end -= WEEK
    return end - WEEK, end


def last_service_week_number(now: datetime | None = None) -> int:
    return last_service_week(now)[0].isocalendar().week


def last_calendar_week(today: date | None = None) -> tuple[date, date]:
    """Monday and Sunday of the last week that ended before ``today``."""
    today = today or wall_clock().date()
    monday = today - timedelta(days=today.weekday()) - WEEK
    return monday, monday + timedelta(days=6)


def last_friday_week(now: datetime | None = None) -> tuple[date, date]:
    """Friday and Thursday of the last closed Friday-to-Thursday week."""
    today = wall_clock(now).date()
    friday = today - timedelta(days=(today.weekday() - 4) % 7) - WEEK
    return friday, friday + timedelta(days=6)


def today(now: datetime | None = None) -> date:
    return wall_clock(now).date()


def yesterday(now: datetime | None = None) -> date:
    return today(now) - timedelta(days=1)


def service_week(stamp: Column) -> Column:
    """Date of the Monday on which the service week of ``stamp`` starts."""
    shifted = stamp.cast("timestamp_ntz") - F.expr(_SERVICE_SHIFT)
    return F.date_trunc("week", shifted).cast("date")


def service_week_of(stamp: datetime) -> date:
    """Driver-side twin of ``service_week``."""
    day = (stamp - timedelta(hours=3, minutes=20)).date()
    return day - timedelta(days=day.weekday())


def service_week_number(stamp: Column) -> Column:
    return F.weekofyear(service_week(stamp))


def calendar_week(stamp: Column) -> Column:
    """Monday of the calendar week."""
    return F.date_trunc("week", stamp).cast("date")


def friday_week(stamp: Column) -> Column:
    """Friday on which the Friday-to-Thursday week starts."""
    day = stamp.cast("date")
    return F.date_sub(day, F.pmod(F.weekday(day) - 4, F.lit(7)))


def local_wall_clock(stamp: Column, zone: str = ZONE) -> Column:
    """Zoned timestamp to the local wall clock, without zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), stamp.cast("timestamp_ntz"))


def local_day(stamp: Column, zone: str = ZONE) -> Column:
    """Local date of a zoned timestamp."""
    return local_wall_clock(stamp, zone).cast("date")
