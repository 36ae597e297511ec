import random
from collections import Counter, defaultdict
from datetime import datetime, time

import pytest
from pyspark.sql import functions as F

from cadencia.functions import clock
from cadencia.operators.schedule import scheduled_gaps
from cadencia.operators.trips import headways, typed_trips
from cadencia.plans.jobs import SCHEDULED_GAPS_SQL
from cadencia.plans.store import dry_run
from cadencia.schemas import HEADWAY_SCHEMA, TRIP_FIELDS, trip_schema

HEADERS = [f.header for f in TRIP_FIELDS]


def columns(schema):
    return [(f.name, f.dataType) for f in schema]


def raw(spark, rows):
    """Trip report rows from (day, route, vehicle, planned, actual, diff, status)."""
    at = {h: i for i, h in enumerate(("Fecha", "Ruta", "Vehiculo real", "Partida Planeada", "Partida Real", "Diff Partida", "Status del Viaje"))}
    full = [tuple(r[at[h]] if h in at else None for h in HEADERS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"`{h}` string" for h in HEADERS))


def test_typed_trips(spark):
    df = typed_trips(raw(spark, [
        ("01/07/2026", "L1", "12.7", "05:00:00", "-", "-00:01:00", "2"),
        ("bad", None, None, "24:00:00", "5:1:2", None, None),
    ]))
    assert columns(df.schema) == columns(trip_schema())
    first, second = df.collect()
    assert first.FECHA == datetime(2026, 7, 1) and first.VEHICULO_REAL == 12
    assert first.PARTIDA_PLANEADA == time(5) and first.PARTIDA_REAL is None
    assert first.DIFF_PARTIDA == "-00:01:00" and first.KM_REALIZADO == 0.0
    assert second.FECHA is None and second.PARTIDA_REAL == time(5, 1, 2) and second.STATUS_DEL_VIAJE == 0


def test_missing_header_is_an_error(spark):
    with pytest.raises(ValueError, match="I.P.K"):
        df = raw(spark, [("01/07/2026",) + ("x",) * 6])
        typed_trips(df.select(*[f"`{c}`" for c in df.columns if c != "I.P.K"]))


def brute_headways(rows):
    """Departures and gaps per day and route, by sorting; vehicles are left out, ties may swap them."""
    groups = defaultdict(list)
    for row in set(rows):
        day, route, vehicle, _, actual, diff, status = row
        if status in ("1", "1.0") and day != "-" and route is not None and actual != "-":
            groups[day, route].append((actual, vehicle))
    gaps = Counter()
    for (day, route), departures in groups.items():
        times = sorted(datetime.strptime(a, "%H:%M:%S") for a, _ in departures)
        for a, b in zip(times, times[1:]):
            gaps[day, route, a.strftime("%H:%M:%S"), (b - a).total_seconds() / 60] += 1
    return gaps


def test_headways_against_sorting(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(600):
        # A third of the rows share one day and route, many of them the second as well.
        hot = rng.random() < 0.35
        day = "01/07/2026" if hot else rng.choice(["01/07/2026", "02/07/2026", "-"])
        route = "L1" if hot else rng.choice(["L1", "L2", None])
        actual = f"{rng.randrange(4, 8):02d}:{rng.randrange(3):02d}:00" if rng.random() < 0.9 else "-"
        rows.append((day, route, str(rng.randrange(90)), "-", actual, "00:00:00", rng.choice(["1", "1", "2", "1.0"])))
    rows += rows[:200]
    result = headways(raw(spark, rows)).collect()
    ours = Counter(
        (f"{r.FECHA:%d/%m/%Y}", r.RUTA, f"{r.TIMESTAMP_SALIDA:%H:%M:%S}", r.INTERVALO_MINUTOS) for r in result
    )
    assert ours == brute_headways(rows)


def test_headway_columns_and_rules(spark):
    df = headways(raw(spark, [
        ("01/07/2026", "L1", "10", "-", "05:59:00", "-00:03:00", "1"),
        ("01/07/2026", "L1", "10", "-", "05:59:00", "-00:03:00", "1"),  # copy
        ("01/07/2026", "L1", "-", "-", "06:10:00", "00:03:00", "1"),  # no vehicle: departs, then leaves
        ("01/07/2026", "L1", "12", "-", "06:11:30", "00:01:00", "1"),
        ("01/07/2026", "L1", "13", "-", "06:12:00", "x", "2"),  # did not run
        ("01/07/2026", "L1", "14", "-", "06:20:00", "x", "1"),  # last of the day
    ]))
    assert columns(df.schema) == columns(HEADWAY_SCHEMA)
    early, late = df.orderBy("TIMESTAMP_SALIDA").collect()
    assert (early.INTERVALO, early.INTERVALO_MINUTOS, early.TURNO) == ("0 days 00:11:00", 11.0, "nan")
    assert (early.ESTADO, early.DIFF_PARTIDA, early.ECONOMICO) == ("Adelanta", 3.0, 10.0)
    assert early.PARTIDA_REAL == datetime(1900, 1, 1, 5, 59) and early.DIA_DE_LA_SEMANA == 2
    assert (late.INTERVALO_MINUTOS, late.TURNO, late.FRANJA_HORARIA) == (8.5, "Matutino", 6)
    assert late.SALIDA_SIGUIENTE == datetime(2026, 7, 1, 6, 20)


def test_unmapped_shift_can_be_dropped(spark):
    rows = [("01/07/2026", "L1", "1", "-", t, "x", "1") for t in ("05:00:00", "06:00:00", "07:00:00")]
    assert headways(raw(spark, rows), unmapped_shift="drop").count() == 1


def test_scheduled_gaps(spark, schema):
    rng = random.Random(3)
    rows = [
        (rng.choice(["01/07/2026", "02/07/2026"]), rng.choice(["L1", "L2", None]), "1",
         "-" if rng.random() < 0.1 else f"{rng.randrange(5, 9):02d}:{rng.randrange(8):02d}:00", "-", "x", "2")
        for _ in range(150)
    ]
    expected, groups = {}, defaultdict(list)
    for day, route, _, planned, *_ in rows:
        if planned != "-":
            groups[day, route].append(datetime.strptime(planned, "%H:%M:%S"))
    for key, times in groups.items():
        times.sort()
        for a, b in zip(times, times[1:]):
            slot = (*key, b.hour)
            expected[slot] = max(expected.get(slot, 0), (b - a).total_seconds() / 2)
    trips = typed_trips(raw(spark, rows))
    trips.write.saveAsTable(f"{schema}.trips")
    by_sql, _ = dry_run(spark, SCHEDULED_GAPS_SQL, f"{schema}.trips")
    for result in (scheduled_gaps(trips), by_sql):
        ours = {(f"{r.FECHA:%d/%m/%Y}", r.RUTA, r.HORA): r.INTERVALO_SEC for r in result.collect()}
        assert ours == expected


def test_clock_texts_are_written_in_full_without_arithmetic(spark):
    texts = ["5:6:7", "05:06:07", "23:59:59", "24:00:00", "-", "", None, "5:6:7\n", "05:06:07\r\n", "1:2", "12:60:00", " 1:2:3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = df.select("t", clock.plain_clock(F.col("t")).alias("p"), clock.clock_text(clock.clock_seconds(F.col("t"))).alias("s"))
    assert all(r.p == r.s for r in plain.collect())
    typed = typed_trips(df.select(*[F.col("t").alias(f.header) for f in TRIP_FIELDS]), clock_as="text")
    assert "interval" not in typed._jdf.queryExecution().optimizedPlan().toString().lower()


def test_trips_of_one_row_group_are_read_by_several_tasks(spark, tmp_path):
    from checks.views import raw_trips

    events = spark.range(0, 40_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-08 05:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value", "'' AS props")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = raw_trips(spark, str(tmp_path), bad_days=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and sum(sizes) == 40_800 and max(sizes) < 11_500
