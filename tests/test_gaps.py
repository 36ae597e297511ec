"""Gaps recomputed where trips changed, against a rebuild over the whole history."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cadencia.operators.prints import changed_groups, fingerprint
from cadencia.operators.ranges import RangeKey
from cadencia.operators.schedule import scheduled_gaps
from cadencia.plans import gaps as plans_gaps
from cadencia.plans.gaps import refresh_gaps
from cadencia.plans.jobs import SCHEDULED_GAPS_SQL
from cadencia.plans.store import create_history, quoted, rebuild_table, replace_range

KEY = RangeKey("FECHA", "PARTIDA_REAL", "PARTIDA_PLANEADA")
MONDAY = datetime(2026, 7, 6, 3, 20)
WEEKS = [(MONDAY + timedelta(weeks=n), MONDAY + timedelta(weeks=n + 1)) for n in range(3)]


def trips(spark, weeks, seed=0, routes=("L1", "L2", None), n=200):
    rng = random.Random(seed)
    rows = []
    for start, _ in weeks:
        for _ in range(n):
            at = start + timedelta(minutes=5 * rng.randrange(7 * 288))
            plan = None if rng.random() < 0.1 else f"{at:%H:%M}:00"
            rows.append((datetime(at.year, at.month, at.day), rng.choice(routes), f"{at:%H:%M}:30", plan))
    return spark.createDataFrame(rows, "FECHA timestamp_ntz, RUTA string, PARTIDA_REAL string, PARTIDA_PLANEADA string")


def rows_of(df):
    return Counter((r.FECHA, r.RUTA, r.HORA, r.INTERVALO_SEC) for r in df.collect())


def assert_current(spark, schema):
    assert rows_of(spark.table(f"{schema}.gaps")) == rows_of(scheduled_gaps(spark.table(f"{schema}.trips")))


def test_equals_the_full_rebuild_after_each_replace(spark, schema):
    create_history(trips(spark, WEEKS), f"{schema}.trips", KEY)
    first = refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    assert first.weeks_read == first.weeks == 3 and first.rows == spark.table(f"{schema}.gaps").count()
    assert_current(spark, schema)
    assert refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps") == (first.rows, 0, 3, 0)
    for seed, week in ((1, WEEKS[1]), (2, WEEKS[0]), (3, WEEKS[2])):
        replace_range(trips(spark, [week], seed, routes=("L1", "L3")), f"{schema}.trips", KEY, *week)
        found = refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
        # Seven days and the first hours of an eighth, on four routes at most.
        assert found.weeks_read == 1 and 0 < found.groups_rebuilt <= 8 * 4
        assert_current(spark, schema)


def test_only_the_changed_groups_are_rebuilt(spark, schema):
    base = trips(spark, WEEKS)
    create_history(base, f"{schema}.trips", KEY)
    refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    inside = base.filter((F.col("FECHA") >= "2026-07-13") & (F.col("FECHA") < "2026-07-19"))
    window = (datetime(2026, 7, 13), datetime(2026, 7, 19))
    hit = (F.col("FECHA") == "2026-07-15") & F.col("RUTA").isNull()
    moved = inside.withColumn("PARTIDA_PLANEADA", F.when(hit, F.lit("12:00:00")).otherwise(F.col("PARTIDA_PLANEADA")))
    for new, groups in ((inside, 0), (moved, 1), (moved, 0)):
        replace_range(new, f"{schema}.trips", KEY, *window)
        # Monday's first hours lie in the week before.
        found = refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
        assert found.weeks_read == 2 and found.groups_rebuilt == groups
        assert_current(spark, schema)


def test_a_run_that_dies_is_made_up_for(spark, schema, monkeypatch):
    create_history(trips(spark, WEEKS), f"{schema}.trips", KEY)
    refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    before = rows_of(spark.table(f"{schema}.gaps"))
    replace_range(trips(spark, WEEKS[1:2], 5), f"{schema}.trips", KEY, *WEEKS[1])
    with monkeypatch.context() as m:
        m.setattr(plans_gaps, "put_version", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    assert rows_of(spark.table(f"{schema}.gaps")) == before
    assert refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps").weeks_read == 1
    assert_current(spark, schema)


def test_full_rebuilds_and_refreshes_may_alternate(spark, schema):
    create_history(trips(spark, WEEKS), f"{schema}.trips", KEY)
    typed = spark.table(quoted(f"{schema}.trips")).withColumn("PARTIDA_PLANEADA", F.to_timestamp("PARTIDA_PLANEADA"))
    typed.write.saveAsTable(f"{schema}.plain")
    n = rebuild_table(spark, SCHEDULED_GAPS_SQL, f"{schema}.plain", f"{schema}.gaps")
    # No ledger lies beside a full rebuild.
    assert refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")[:2] == (n, 3)
    assert refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps").weeks_read == 0
    rebuild_table(spark, SCHEDULED_GAPS_SQL, f"{schema}.plain", f"{schema}.gaps")
    assert refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps").weeks_read == 3
    assert_current(spark, schema)


def test_guards(spark, schema):
    trips(spark, WEEKS).write.saveAsTable(f"{schema}.plain")
    with pytest.raises(ValueError):
        refresh_gaps(spark, f"{schema}.plain", f"{schema}.gaps")
    create_history(trips(spark, WEEKS[:1]).limit(0), f"{schema}.empty", KEY)
    with pytest.raises(RuntimeError):
        refresh_gaps(spark, f"{schema}.empty", f"{schema}.gaps")
    create_history(trips(spark, WEEKS), f"{schema}.trips", KEY)
    refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    before = rows_of(spark.table(f"{schema}.gaps"))
    replace_range(trips(spark, WEEKS[:1], n=2), f"{schema}.trips", KEY, *WEEKS[0])
    with pytest.raises(RuntimeError):
        refresh_gaps(spark, f"{schema}.trips", f"{schema}.gaps")
    assert rows_of(spark.table(f"{schema}.gaps")) == before


def test_fingerprints(spark):
    def prints(rows):
        return fingerprint(spark.createDataFrame(rows, "g string, a string, b string, x double"), ["g"])

    def differ(left, right):
        return sorted((r.g for r in changed_groups(prints(left), prints(right), ["g"]).collect()), key=str)

    rows = [("1", "a", None, 0.0), ("1", "a", None, 0.0), ("2", None, None, None), (None, "n", "n", 1.5)]
    assert differ(rows, rows[::-1]) == []
    assert differ(rows, rows[1:]) == ["1"] and differ(rows, rows[:3]) == [None] and differ(rows, []) == ["1", "2", None]
    assert differ(rows, [("1", None, "a", 0.0), *rows[1:]]) == ["1"]
    assert differ(rows, [("1", "a", None, -0.0), *rows[1:]]) == ["1"]
    # Two copies of one row and two of another are not the same multiset as one and three.
    assert differ([("1", "a", "b", 1.0)] * 2 + [("1", "b", "a", 1.0)] * 2, [("1", "a", "b", 1.0)] * 3 + [("1", "b", "a", 1.0)]) == ["1"]


def test_any_type_has_a_fingerprint(spark):
    df = spark.sql(
        "SELECT 1 AS g, map('k', 1) AS m, array(1.5, null) AS l, named_struct('f', x'00') AS s, parse_json('{\"a\": 1}') AS v, "
        "DATE'2026-01-01' AS d, TIME'10:00:00' AS t, CAST(1.5 AS DECIMAL(30, 2)) AS n, x'01' AS b"
    )
    other = df.withColumn("t", F.expr("TIME'10:00:01'"))
    assert changed_groups(fingerprint(df, ["g"]), fingerprint(df, ["g"]), ["g"]).isEmpty()
    assert not changed_groups(fingerprint(df, ["g"]), fingerprint(other, ["g"]), ["g"]).isEmpty()
