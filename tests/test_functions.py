from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from cadencia.functions import calendar, clock, numbers, shifts, text


def values(spark, kind, inputs, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    rows = df.select("i", expr(F.col("c")).alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


def test_numbers(spark):
    texts = ["12", "12.7", "-3.9", " 5 ", "1e2", "-", None, "1d", "x", "."]
    assert values(spark, "string", texts, numbers.whole_or_zero) == [12, 12, -3, 5, 100, 0, 0, 0, 0, 0]
    assert values(spark, "string", texts, numbers.real_or_zero)[:3] == [12.0, 12.7, -3.9]
    assert values(spark, "string", ["5.0", "x", None, "7"], numbers.whole_or_null) == [5, None, None, 7]
    with pytest.raises(Exception, match="not a whole number"):
        values(spark, "string", ["5.5"], numbers.whole_or_null)


def test_signed_minutes(spark):
    texts = ["-00:02:30", "00:02:30", "00:00:00", " -00:01:00", None, "-", "+01:00:00"]
    early = values(spark, "string", texts, lambda c: numbers.signed_minutes(c, True))
    assert early == [2.5, -2.5, 0.0, -1.0, 0.0, 0.0, -60.0]
    assert str(early[2]) == "0.0" and str(early[4]) == "0.0"
    natural = values(spark, "string", texts, lambda c: numbers.signed_minutes(c, False))
    assert natural == [-2.5, 2.5, 0.0, 1.0, 0.0, 0.0, 60.0]


def test_clock_parsing(spark):
    texts = ["08:09:10", "8:9:1", "-", "24:00:00", "23:59:59", " 08:00:00", None, "08:60:00"]
    seconds = values(spark, "string", texts, clock.clock_seconds)
    assert seconds == [29350, 28800 + 541, None, None, 86399, None, None, None]
    assert values(spark, "int", [0, 86399, None], clock.clock_text) == ["00:00:00", "23:59:59", None]
    assert values(spark, "int", [750, 3600 * 23], clock.gap_text) == ["0 days 00:12:30", "0 days 23:00:00"]


def test_days(spark):
    texts = ["01/07/2026", "1/7/2026", "31/02/2026", "2026-07-01", "-", None, "1/7/20260"]
    day = date(2026, 7, 1)
    assert values(spark, "string", texts, clock.report_day) == [day, day, None, None, None, None, None]
    assert values(spark, "string", ["20260701"], clock.strict_compact_day) == [datetime(2026, 7, 1)]
    with pytest.raises(Exception, match="not a yyyyMMdd date"):
        values(spark, "string", ["2026-07-01"], clock.strict_compact_day)
    stamps = values(spark, "string", ["01/07/2026 05:06:07", "2026-07-01 05:06", "x"], lambda c: clock.report_stamp(c, unreadable="null"))
    assert stamps == [datetime(2026, 7, 1, 5, 6, 7), None, None]
    assert values(spark, "date", [day], clock.day_tag) == ["010726"]
    assert values(spark, "date", [date(2026, 6, 22), date(2026, 6, 28)], clock.weekday) == [0, 6]


def test_stamp_text_keeps_nulls(spark):
    assert values(spark, "timestamp_ntz", [None, datetime(2026, 1, 2)], clock.stamp_text) == [None, "2026-01-02 00:00:00"]


def test_shift_bounds(spark):
    hours = [0, 5, 6, 10, 11, 16, 17, 23]
    assert values(spark, "int", hours, shifts.departure_shift) == [
        None, None, "Matutino", "Matutino", "Intermedio", "Intermedio", "Vespertino", "Vespertino"
    ]
    assert values(spark, "int", [0, 1, 3, 4, 11, 12, 23], shifts.clock_shift) == [
        "Vespertino", "Ninguno", "Ninguno", "Matutino", "Matutino", "Vespertino", "Vespertino"
    ]
    assert values(spark, "double", [2.0, -2.0, 2.1, -2.1], shifts.punctuality) == [
        "En tiempo", "En tiempo", "Adelanta", "Retrasa"
    ]


def test_names(spark):
    assert text.warehouse_name("Económico planificado") == "ECONOMICO_PLANIFICADO"
    assert text.warehouse_name("I.P.K") == "I_P_K"
    assert text.warehouse_name("24 horas") == "_24_HORAS"
    assert values(spark, "string", ["Económico Ñ"], text.strip_accents) == ["Economico N"]
    assert values(spark, "string", ["NA", "-", "", None, "nan", "x"], text.null_if_na) == [None, "-", None, None, None, "x"]
    df = spark.createDataFrame([(1, 2)], "`﻿Fecha` int, b int")
    assert text.without_bom(df).columns == ["Fecha", "b"]
    assert text.with_warehouse_names(spark.createDataFrame([(1,)], "`Vel. promedio Km` int")).columns == ["VEL_PROMEDIO_KM"]


@pytest.mark.parametrize(
    "today, monday, sunday",
    [
        (date(2026, 6, 24), date(2026, 6, 15), date(2026, 6, 21)),
        (date(2026, 6, 22), date(2026, 6, 15), date(2026, 6, 21)),
        (date(2026, 6, 21), date(2026, 6, 8), date(2026, 6, 14)),
        (date(2026, 7, 13), date(2026, 7, 6), date(2026, 7, 12)),
    ],
)
def test_calendar_week(today, monday, sunday):
    assert calendar.last_calendar_week(today) == (monday, sunday)


def test_service_week_edges():
    before, at = datetime(2026, 7, 13, 3, 19, 59), datetime(2026, 7, 13, 3, 20)
    assert calendar.last_service_week(before) == (datetime(2026, 6, 29, 3, 20), datetime(2026, 7, 6, 3, 20))
    assert calendar.last_service_week(at) == (datetime(2026, 7, 6, 3, 20), at)
    utc = datetime(2026, 7, 13, 9, 20, tzinfo=ZoneInfo("UTC"))
    assert calendar.last_service_week(utc) == calendar.last_service_week(at)
    assert calendar.last_service_week_number(at) == 28
    assert calendar.yesterday(at) == date(2026, 7, 12)


def test_friday_week():
    friday, thursday = date(2026, 7, 3), date(2026, 7, 9)
    assert calendar.last_friday_week(datetime(2026, 7, 10, 8)) == (friday, thursday)
    assert calendar.last_friday_week(datetime(2026, 7, 16, 8)) == (friday, thursday)


def test_week_columns(spark):
    stamps = [datetime(2026, 7, 13, 3, 19, 59), datetime(2026, 7, 13, 3, 20), datetime(2026, 7, 10), datetime(2026, 7, 9)]
    weeks = values(spark, "timestamp_ntz", stamps, calendar.service_week)
    assert weeks == [calendar.service_week_of(s) for s in stamps]
    assert weeks[:2] == [date(2026, 7, 6), date(2026, 7, 13)]
    fridays = values(spark, "timestamp_ntz", stamps, calendar.friday_week)
    assert fridays == [date(2026, 7, 10), date(2026, 7, 10), date(2026, 7, 10), date(2026, 7, 3)]
    assert values(spark, "timestamp_ntz", stamps[:1], calendar.calendar_week) == [date(2026, 7, 13)]
    zoned = calendar.local_wall_clock(F.lit("2026-07-01 05:00:00").cast("timestamp"))
    assert spark.range(1).select(zoned.alias("v")).first().v == datetime(2026, 6, 30, 23)


def test_unreadable_stamps_are_counted_and_refused(spark):
    texts = ["2026-07-01 05:06:07.123", "01/07/2026 05:06:07", "1/7/2026 5:06:07 p. m.", "  ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.agg(clock.unreadable_stamps(F.col("t")).alias("n")).first().n == 1
    read = df.filter("coalesce(t, '') not like '%m.'").select(clock.report_stamp(F.col("t")).alias("v")).collect()
    assert [r.v for r in read] == [datetime(2026, 7, 1, 5, 6, 7, 123000), datetime(2026, 7, 1, 5, 6, 7), None, None]
    with pytest.raises(Exception, match="unreadable time stamp"):
        df.select(clock.report_stamp(F.col("t"))).collect()
