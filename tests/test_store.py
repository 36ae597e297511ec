import os
from collections import Counter
from datetime import datetime, timedelta

import pytest

from cadencia.operators.ranges import RangeKey, check_window_arguments, count_between_days, date_filter
from cadencia.plans.store import (
    checked_name,
    dry_run,
    finish_replace,
    quoted,
    rebuild_table,
    replace_range,
    row_count,
    weeks_touched,
)

KEY = RangeKey("FECHA", "PARTIDA_REAL", "PARTIDA_PLANEADA")
A = (datetime(2026, 7, 6, 3, 20), datetime(2026, 7, 13, 3, 20))
B = (A[1], A[1] + timedelta(days=7))
COLUMNS = "FECHA timestamp_ntz, PARTIDA_REAL string, PARTIDA_PLANEADA string, v int"


def rows(spark, *items):
    return spark.createDataFrame([(datetime(2026, 7, d), real, plan, v) for d, real, plan, v in items], COLUMNS)


def content(spark, table):
    return Counter((r.FECHA.day, r.PARTIDA_REAL, r.PARTIDA_PLANEADA, r.v) for r in spark.table(quoted(table)).collect())


def week_a(spark, v=1):
    # Monday 03:19 of the next week still belongs to week A; a cancelled trip has its plan only.
    return rows(spark, (6, "03:20:00", None, v), (8, "10:00:00", None, v), (9, None, "11:00:00", v), (13, "03:19:59", None, v))


def week_b(spark, v=2):
    return rows(spark, (13, "03:20:00", None, v), (15, None, "10:00:00", v))


def test_replace_is_idempotent_and_selective(spark, schema):
    table = f"{schema}.trips"
    assert replace_range(week_a(spark), table, KEY, *A) == 4
    first = content(spark, table)
    replace_range(week_a(spark), table, KEY, *A)
    assert content(spark, table) == first
    replace_range(week_b(spark), table, KEY, *B)
    assert row_count(spark, table) == 6
    replace_range(week_b(spark, 3), table, KEY, *B)
    both = content(spark, table)
    assert {k: n for k, n in both.items() if k[3] == 1} == first
    assert sum(n for k, n in both.items() if k[3] == 3) == 2 and row_count(spark, table) == 6
    assert count_between_days(spark.table(table), "FECHA", A[0].date(), A[1].date()) == 5


def test_guard_stops_before_anything_is_replaced(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    before = content(spark, table)
    for new, window in (
        (week_b(spark), A),
        (rows(spark, (9, None, "10:00:00", 1)), A),
        (rows(spark), A),
        (week_a(spark).selectExpr("CAST(NULL AS timestamp_ntz) AS FECHA", "PARTIDA_REAL", "PARTIDA_PLANEADA", "v"), A),
    ):
        with pytest.raises(RuntimeError):
            replace_range(new, table, KEY, *window)
        assert content(spark, table) == before
    with pytest.raises(ValueError):
        check_window_arguments(A[1], A[0])
    with pytest.raises(ValueError):
        check_window_arguments(*A, "TIME")


def test_stray_rows(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_b(spark), table, KEY, *B)
    # Neither time is known: midnight of Monday lies before the window.
    stray = week_b(spark).unionAll(rows(spark, (13, None, None, 9)))
    with pytest.raises(RuntimeError, match="outside the window"):
        replace_range(stray, table, KEY, *B, stray="reject")
    replace_range(week_a(spark), table, KEY, *A)
    for _ in range(2):
        replace_range(stray, table, KEY, *B)
        kept = content(spark, table)
        assert kept[13, None, None, 9] == 1
        assert sum(n for k, n in kept.items() if k[3] == 1) == 4


def test_week_that_ends_empty_is_cleared(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    replace_range(week_b(spark), table, KEY, *B)
    replace_range(week_b(spark, 5), table, KEY, A[0], B[1])
    assert {k[3] for k in content(spark, table)} == {5}
    assert len(weeks_touched(A[0], B[1])) == 2 and len(weeks_touched(*A)) == 1


def test_interrupted_replace_is_finished_by_the_next_run(spark, schema, monkeypatch):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    calls = []
    real = finish_replace

    def die_at_the_swap(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("killed")
        return real(*args)

    monkeypatch.setattr("cadencia.plans.store.finish_replace", die_at_the_swap)
    with pytest.raises(OSError):
        replace_range(week_a(spark, 7), table, KEY, *A)
    assert {k[3] for k in content(spark, table)} == {1}
    monkeypatch.setattr("cadencia.plans.store.finish_replace", real)
    assert finish_replace(spark, table) and not finish_replace(spark, table)
    assert {k[3] for k in content(spark, table)} == {7} and row_count(spark, table) == 4


def test_stage_outlives_its_application_and_is_refused_without_its_rows(spark, schema, monkeypatch):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    before = content(spark, table)
    real, calls = finish_replace, []

    def die_at_the_swap(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("killed")
        return real(*args)

    def location():
        return spark.sql(f"DESCRIBE FORMATTED {table}__staged").filter("col_name = 'Location'").first()["data_type"]

    monkeypatch.setattr("cadencia.plans.store.finish_replace", die_at_the_swap)
    with pytest.raises(OSError):
        replace_range(week_a(spark, 7), table, KEY, *A)
    monkeypatch.setattr("cadencia.plans.store.finish_replace", real)
    path = location().removeprefix("file:")
    assert spark.sparkContext.applicationId not in path
    kept = spark.read.parquet(path).localCheckpoint()
    kept.limit(1).write.mode("overwrite").parquet(path)
    spark.catalog.refreshTable(f"{table}__staged")
    with pytest.raises(RuntimeError, match="nothing was replaced"):
        finish_replace(spark, table)
    assert content(spark, table) == before
    kept.write.mode("overwrite").parquet(path)
    spark.catalog.refreshTable(f"{table}__staged")
    assert finish_replace(spark, table) and {k[3] for k in content(spark, table)} == {7}
    assert not os.path.exists(path)


SQL = "SELECT v, count(*) AS n FROM IDENTIFIER(:source_table) GROUP BY v;"


def test_rebuild_gates(spark, schema):
    source, dest = f"{schema}.src", f"{schema}.dst"
    spark.range(20).selectExpr("id AS v").write.saveAsTable(source)
    assert row_count(spark, dest) is None
    assert rebuild_table(spark, SQL, source, dest) == 20
    assert rebuild_table(spark, SQL, source, dest) == 20
    spark.range(18).selectExpr("id AS v").write.mode("overwrite").saveAsTable(source)
    assert rebuild_table(spark, SQL, source, dest) == 18
    spark.range(15).selectExpr("id AS v").write.mode("overwrite").saveAsTable(source)
    with pytest.raises(RuntimeError, match="shrink"):
        rebuild_table(spark, SQL, source, dest)
    assert row_count(spark, dest) == 18
    assert rebuild_table(spark, SQL, source, dest, min_row_ratio=0.0) == 15
    spark.range(0).selectExpr("id AS v").write.mode("overwrite").saveAsTable(source)
    with pytest.raises(RuntimeError, match="no rows"):
        rebuild_table(spark, SQL, source, dest, min_row_ratio=0.0)
    assert row_count(spark, dest) == 15
    assert {t.name for t in spark.catalog.listTables(schema)} == {"src", "dst"}


def test_rebuild_finds_faults_before_running(spark, schema):
    dest = f"{schema}.dst"
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        rebuild_table(spark, SQL, f"{schema}.missing", dest)
    with pytest.raises(RuntimeError, match="source_table"):
        rebuild_table(spark, "SELECT 1", f"{schema}.src", dest)
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        rebuild_table(spark, "SELEC v FROM IDENTIFIER(:source_table)", f"{schema}.src", dest)
    assert row_count(spark, dest) is None
    spark.range(5).selectExpr("id AS v").write.saveAsTable(f"{schema}.src")
    assert dry_run(spark, SQL, f"{schema}.src")[1] != "unknown"


@pytest.mark.parametrize("name", ["p.d.t;DROP TABLE x", "p.d.t`; DROP TABLE x; --", "p.d.with space", "one", "", None, "a.b.c.d"])
def test_bad_table_names(name):
    with pytest.raises(ValueError):
        checked_name(name)


def test_date_filter(spark):
    df = week_a(spark)
    assert date_filter(df, "2026-07-08").count() == 3
    assert date_filter(df, "2026-07-08", "2026-07-13").count() == 2
    assert date_filter(df.drop("FECHA"), "2026-07-08").count() == 4
