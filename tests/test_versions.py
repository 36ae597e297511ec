"""Readers during a swap, and writers that meet."""

import threading

import pytest

from cadencia.plans import versions
from cadencia.plans.store import create_history, drop_history, rebuild_table, replace_range, row_count
from cadencia.plans.versions import KEPT_VERSIONS, current, data_folder, folders, locked, publish, quoted
from cadencia.schemas import PARTITION_COLUMN

from test_store import A, B, KEY, SQL, content, week_a, week_b


class Reader(threading.Thread):
    """Reads over and over until stopped; keeps what it saw and what failed."""

    def __init__(self, look):
        super().__init__(daemon=True)
        self.look, self.seen, self.faults, self.on = look, [], [], True

    def run(self):
        while self.on:
            try:
                self.seen.append(self.look())
            except Exception as fault:  # noqa: BLE001 - kept for the test
                self.faults.append(str(fault)[:300])

    def __enter__(self):
        self.start()
        return self

    def __exit__(self, *exc):
        self.on = False
        self.join()


def test_readers_see_one_version_while_a_range_is_replaced(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark, 0).unionAll(week_b(spark, 0)), table, KEY, A[0], B[1])
    with Reader(lambda: [(r.v, r.n) for r in spark.sql(f"SELECT v, count(*) AS n FROM {table} GROUP BY v").collect()]) as reader:
        for v in range(1, 5):
            replace_range(week_a(spark, v).unionAll(week_b(spark, v)), table, KEY, A[0], B[1])
    assert not reader.faults and len(reader.seen) > 4
    # Both weeks of one run, always.
    assert all(len(seen) == 1 and seen[0][1] == 6 for seen in reader.seen)
    assert [s[0][0] for s in reader.seen] == sorted(s[0][0] for s in reader.seen)


def test_readers_see_one_version_while_a_table_is_rebuilt(spark, schema):
    source, dest = f"{schema}.src", f"{schema}.dst"
    spark.range(40).selectExpr("id % 4 AS v").write.saveAsTable(source)
    rebuild_table(spark, SQL, source, dest)
    with Reader(lambda: sorted((r.v, r.n) for r in spark.table(dest).collect())) as reader:
        for _ in range(3):
            rebuild_table(spark, SQL, source, dest)
    assert not reader.faults and reader.seen and all(seen == [(v, 10) for v in range(4)] for seen in reader.seen)
    assert len(folders(spark, data_folder(spark, dest))) == KEPT_VERSIONS


def test_unchanged_weeks_keep_their_files(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    replace_range(week_b(spark), table, KEY, *B)
    files = lambda week: {r[0] for r in spark.sql(f"SELECT DISTINCT _metadata.file_path FROM {current(spark, table)} WHERE {PARTITION_COLUMN} = DATE'{week}'").collect()}
    first, second = files("2026-07-06"), files("2026-07-13")
    for v in range(5):
        replace_range(week_b(spark, v), table, KEY, *B)
    assert files("2026-07-06") == first and not files("2026-07-13") & second
    assert len([t for t in spark.catalog.listTables(schema) if "__v" in t.name]) == KEPT_VERSIONS
    # The folder of the first week, and one per version that stays.
    assert len(folders(spark, data_folder(spark, table))) == 1 + KEPT_VERSIONS
    drop_history(spark, table)
    assert not spark.catalog.listTables(schema) and not folders(spark, data_folder(spark, table))


def test_a_reader_may_finish_on_the_version_it_began_with(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark, 1), table, KEY, *A)
    began = spark.table(quoted(table))
    for v in range(2, KEPT_VERSIONS + 1):
        replace_range(week_a(spark, v), table, KEY, *A)
        assert {r.v for r in began.collect()} == {1}


def test_writers_exclude_each_other(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    before, faults = content(spark, table), []

    def other():
        try:
            replace_range(week_a(spark, 9), table, KEY, *A)
        except RuntimeError as fault:
            faults.append(str(fault))

    with locked(spark, table):
        with locked(spark, table):  # the same run, again
            thread = threading.Thread(target=other)
            thread.start()
            thread.join()
        assert spark.catalog.tableExists(f"{table}__lock")
    assert len(faults) == 1 and "another run" in faults[0] and content(spark, table) == before
    assert not spark.catalog.tableExists(f"{table}__lock")
    replace_range(week_a(spark, 9), table, KEY, *A)
    assert {k[3] for k in content(spark, table)} == {9}


def test_the_lock_of_a_dead_run_is_taken_over(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    versions._acquire(spark, table, lease=-5)  # its run died
    replace_range(week_a(spark, 3), table, KEY, *A)
    assert {k[3] for k in content(spark, table)} == {3} and not spark.catalog.tableExists(f"{table}__lock")


def test_a_run_that_lost_its_lock_publishes_nothing(spark, schema):
    table = f"{schema}.trips"
    replace_range(week_a(spark), table, KEY, *A)
    version = current(spark, table)
    with locked(spark, table, lease=-5):
        versions._take_over(spark, table, versions._owner(spark, table))
        other = versions._acquire(spark, table, lease=60)
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, table, "nowhere", "none", ["v"])
    assert current(spark, table) == version and versions._owner(spark, table) == other


def test_plain_tables_of_earlier_releases_become_versions(spark, schema):
    table, dest = f"{schema}.trips", f"{schema}.dst"
    from cadencia.plans.store import with_week

    with_week(week_a(spark).unionAll(week_b(spark)), KEY).write.partitionBy(PARTITION_COLUMN).saveAsTable(table)
    replace_range(week_b(spark, 7), table, KEY, *B)
    assert {(k[3], n) for k, n in content(spark, table).items()} == {(1, 1), (7, 1)} and row_count(spark, table) == 6
    spark.range(3).selectExpr("id AS v", "1L AS n").write.saveAsTable(dest)
    spark.range(5).selectExpr("id AS v").write.saveAsTable(f"{schema}.src")
    assert rebuild_table(spark, SQL, f"{schema}.src", dest) == 5 and row_count(spark, dest) == 5
    assert not [t for t in spark.catalog.listTables(schema) if t.name.endswith("__plain")]


def test_a_history_is_created_once(spark, schema):
    create_history(week_a(spark).limit(0), f"{schema}.trips", KEY)
    assert row_count(spark, f"{schema}.trips") == 0
    with pytest.raises(ValueError, match="exists"):
        create_history(week_a(spark), f"{schema}.trips", KEY)
