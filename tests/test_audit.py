from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadencia.operators import audit as operators
from cadencia.operators.audit import (
    compare_schemas,
    discrepancies,
    multiset_summary,
    multisets_equal,
    narrowed,
    narrowed_summary,
    row_hash,
    roundtrip_faults,
)
from cadencia.plans.audit import DIFFERENT, FAULT, IDENTICAL, Pair, audit


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b int")


def test_counts_copies_and_nulls(spark):
    left = frame(spark, [("x", 1)] * 3 + [(None, 2), ("y", None), ("z", 9)])
    right = frame(spark, [("x", 1)] * 2 + [(None, 2), (None, None), ("z", 9), ("z", 9)])
    summary = multiset_summary(left, right).first().asDict()
    assert summary == {"matched_rows": 4, "only_left_rows": 2, "only_right_rows": 2, "left_total": 6, "right_total": 6}
    dump = [tuple(r) for r in discrepancies(left, right).collect()]
    # All copies of a differing row appear on both sides.
    assert sorted(dump, key=str) == sorted(
        [("1_left", "x", 1)] * 3 + [("2_right", "x", 1)] * 2 + [("1_left", "y", None), ("2_right", None, None)]
        + [("1_left", "z", 9)] + [("2_right", "z", 9)] * 2, key=str,
    )
    assert discrepancies(left, right, limit=2).count() == 2
    assert not multisets_equal(left, right) and multisets_equal(left, left.select("b", "a"))


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert list(multiset_summary(empty, empty).first()) == [0] * 5


def test_hash_ignores_column_order_and_keeps_nulls(spark):
    df = frame(spark, [("x", None)])
    one = df.select(row_hash(["a", "b"]).alias("h")).first().h
    assert one == df.select("b", "a").select(row_hash(["b", "a"]).alias("h")).first().h
    assert one != frame(spark, [(None, None)]).select(row_hash(["a", "b"]).alias("h")).first().h


def test_schemas(spark):
    base = frame(spark, [])
    assert compare_schemas(base.schema, base.schema) == (True, [])
    turned = base.select("b", "a")
    assert compare_schemas(base.schema, turned.schema) == (True, ["column order differs"])
    assert not compare_schemas(base.schema, turned.schema, strict_order=True).same
    other = base.select(F.col("a"), F.col("b").cast("bigint"), F.lit(1).alias("c"))
    verdict = compare_schemas(base.schema, other.schema)
    assert not verdict.same and len(verdict.messages) == 2


def test_roundtrip(spark):
    df = frame(spark, [("x", None), ("y", 1)])
    assert roundtrip_faults(df, df, ["a", "b"]) == []
    assert len(roundtrip_faults(df, df.filter("b = 1"), ["a", "b", "c"])) == 2


def test_audit_job(spark, schema, tmp_path):
    base = spark.sql("SELECT DATE'2026-07-01' + CAST(id AS INT) AS FECHA, id AS v FROM range(10)")
    base.write.saveAsTable(f"{schema}.a")
    base.select("v", "FECHA").write.saveAsTable(f"{schema}.b")
    base.withColumn("v", F.when(F.col("v") == 9, 99).otherwise(F.col("v"))).write.saveAsTable(f"{schema}.c")
    base.drop("v").write.saveAsTable(f"{schema}.d")
    pairs = [Pair(n, f"{schema}.a", f"{schema}.{n}") for n in ("b", "c", "d", "missing")]
    code, reports = audit(spark, pairs, "2026-07-01", out_dir=str(tmp_path))
    assert code == FAULT and [r.code for r in reports] == [IDENTICAL, DIFFERENT, FAULT, FAULT]
    dump = spark.read.csv(reports[1].dump, header=True)
    assert dump.columns[0] == "side" and dump.count() == 2
    code, _ = audit(spark, pairs[:2], "2026-07-01", until="2026-07-10")
    assert code == IDENTICAL
    with pytest.raises(ValueError):
        audit(spark, pairs, "10/07/2026")


def test_only_days_that_differ_are_compared_by_row(spark):
    days = spark.sql("SELECT IF(id % 10 = 9, null, DATE'2026-07-01' + CAST(id % 10 AS INT)) AS FECHA, id % 7 AS v, id % 5 = 0 AS w FROM range(400)")
    third = F.col("FECHA") == "2026-07-03"
    other = days.withColumn("v", F.when(third & F.col("w"), 99).otherwise(F.col("v"))).unionAll(days.filter(third).limit(2))
    for column in ("FECHA", None):
        found = narrowed(days, other, column)
        assert narrowed_summary(found) == multiset_summary(days, other).first().asDict()
        assert sorted(map(tuple, discrepancies(found.left, found.right).collect()), key=str) == sorted(
            map(tuple, discrepancies(days, other).collect()), key=str
        )
        assert 0 < found.differing_parts < found.parts and (column is None or found[2:] == (360, 10, 1))
        same = narrowed(days, days.repartition(3), column)
        assert same.differing_parts == 0 and same.equal_rows == 400 and same.left.isEmpty()
        assert narrowed_summary(same) == multiset_summary(days, days).first().asDict()
        none = narrowed(days.limit(0), days.limit(0), column)
        assert list(narrowed_summary(none).values()) == [0] * 5
    gone = narrowed(days, days.filter(F.coalesce(~third, F.lit(True))), "FECHA")
    assert gone.differing_parts == 1 and narrowed_summary(gone)["only_left_rows"] == 40


def test_report_reads_rows_once_and_shuffles_none_to_find_them(spark, monkeypatch):
    """F6, F8: rows are found by a bitmap where they are scanned; the audit's summary comes from the report, not from another count of all rows."""
    left = spark.range(5000).selectExpr("id AS a", "IF(id % 50 = 0, null, id * 0.5D) AS b", "IF(id % 4 = 0, -0.0D, 0.0D) AS c", "id % 3 AS d")
    right = left.filter("a % 101 <> 0").withColumn("b", F.when(F.col("a") % 103 == 0, F.col("b") + 1).otherwise(F.col("b")))
    right = right.unionAll(right.filter("a % 107 = 0")).withColumn("c", F.when(F.col("a") == 8, 0.0).otherwise(F.col("c")))
    written, write = [], operators.materialize
    monkeypatch.setattr(operators, "materialize", lambda df, label, *more: written.append((label, df)) or write(df, label, *more))
    hashed, paired = [], operators.paired_counts
    monkeypatch.setattr(operators, "paired_counts", lambda l, r: hashed.append(l.count() + r.count()) or paired(l, r))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as where the differing hashes are many
    try:
        summary, rows = operators.narrowed_report(left, right)
        found = Counter(map(str, rows.collect()))
        suspects = next(df for label, df in written if label == "audit-suspects")
        assert "BroadcastHashJoin" in suspects._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    a, b = (Counter(map(str, df.select("a", "b", "c", "d").collect())) for df in (left, right))
    differing = {r for r in a.keys() | b.keys() if a[r] != b[r]}
    expected = Counter({r.replace("Row(", f"Row(side='{side}', "): n for side, rows_ in (("1_left", a), ("2_right", b)) for r, n in rows_.items() if r in differing})
    assert found == expected and sum(expected.values()) < 500
    assert summary == multiset_summary(left, right).first().asDict()
    assert hashed[0] == sum(expected.values())  # before: all rows of both sides


def test_rows_that_share_a_hash_are_told_apart(spark, monkeypatch):
    """A suspect's hash may be that of equal rows too; those are not in the report."""
    left, right = frame(spark, [("x", 1), ("y", 2), (None, 3)]), frame(spark, [("x", 1), ("y", 5), (None, 3)])
    monkeypatch.setattr(operators, "row_prints", lambda df, columns: [F.lit(7).cast("bigint"), F.xxhash64(*columns)])
    assert sorted(map(tuple, discrepancies(left, right).collect())) == [("1_left", "y", 2), ("2_right", "y", 5)]
