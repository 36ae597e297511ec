import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadencia.operators import outliers
from cadencia.operators.outliers import depth_cuts, depth_scores, training_pool, warn_if_over_cut, without_outliers
from cadencia.session import materialize


def headway_rows(spark, n=3000):
    rng = np.random.default_rng(1)
    rows = [
        ("L1" if i % 3 else "L2", float(rng.integers(100, 140)), float(rng.normal(0, 2)), float(rng.normal(8, 2)),
         int(rng.integers(0, 7)), int(rng.integers(5, 23)), i)
        for i in range(n)
    ]
    rows.append(("L1", 120.0, 400.0, 900.0, 3, 12, -1))  # planted
    rows.append(("ONE", 1.0, 1.0, 1.0, 1, 1, -2))
    rows += [("SAME", 1.0, 1.0, 1.0, 1, 1, -3)] * 300
    names = ("RUTA string, ECONOMICO double, DIFF_PARTIDA double, INTERVALO_MINUTOS double, "
             "DIA_DE_LA_SEMANA bigint, FRANJA_HORARIA bigint, id int")
    return spark.createDataFrame(rows, names)


def test_removes_about_one_percent_and_the_planted_row(spark):
    df = headway_rows(spark)
    kept = without_outliers(df)
    assert kept.columns == df.columns
    ids = sorted(r.id for r in kept.collect())
    by_route = {r.RUTA: r["count"] for r in kept.groupBy("RUTA").count().collect()}
    assert -1 not in ids and -2 in ids and by_route["SAME"] == 300 and by_route["ONE"] == 1
    assert 1950 <= by_route["L1"] <= 1995 and 970 <= by_route["L2"] <= 995
    again = sorted(r.id for r in without_outliers(df.repartition(7)).collect())
    assert again == ids


def test_pool_is_bounded_and_proportional(spark):
    df = headway_rows(spark)
    sizes = df.groupBy("RUTA").agg(F.count("*").alias("group_rows")).withColumn("pieces", F.lit(1).cast("bigint"))
    pool = training_pool(df, sizes, "RUTA", outliers.FEATURES, 600)
    copies = {r.RUTA: r.n for r in pool.groupBy("RUTA").agg(F.sum("copies").alias("n")).collect()}
    assert 500 < copies["L1"] < 700 and copies["SAME"] == 300 and copies["ONE"] == 1


def test_pieces_do_not_change_scores(spark, monkeypatch):
    df = materialize(headway_rows(spark), "test")
    whole = sorted((r.id, r.depth) for r in depth_scores(df).collect())
    monkeypatch.setattr(outliers, "PIECE_ROWS", 250)
    assert sorted((r.id, r.depth) for r in depth_scores(df, shared_bytes=0).collect()) == whole


def test_cut_is_the_interpolated_percentile(spark):
    depths = np.random.default_rng(2).integers(1000, 1200, 777)
    scored = spark.createDataFrame([("L", int(d)) for d in depths], "RUTA string, depth bigint")
    assert depth_cuts(scored, contamination=0.03).first().cut == pytest.approx(np.percentile(depths, 3))


def test_warning():
    with pytest.warns(RuntimeWarning, match="removed 60 of 100"):
        warn_if_over_cut(100, 40)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        warn_if_over_cut(100, 50)
        warn_if_over_cut(0, 0)


@pytest.mark.parametrize("shared_bytes", [1 << 27, 0])
def test_rows_without_a_group_are_a_group(spark, monkeypatch, shared_bytes):
    df = materialize(headway_rows(spark), "test")
    named = sorted((r.id, r.depth) for r in depth_scores(df).filter("RUTA = 'L1'").collect())
    missing = materialize(df.withColumn("RUTA", F.when(F.col("RUTA") != "L1", F.col("RUTA"))), "test")
    monkeypatch.setattr(outliers, "PIECE_ROWS", 250)
    scored = depth_scores(missing, shared_bytes=shared_bytes)
    assert scored.count() == df.count()
    assert sorted((r.id, r.depth) for r in scored.filter("RUTA IS NULL").collect()) == named
    kept = without_outliers(missing, stored=True)
    assert {r.RUTA for r in kept.select("RUTA").distinct().collect()} == {None, "L2", "ONE", "SAME"}
    assert -1 not in {r.id for r in kept.collect()}
