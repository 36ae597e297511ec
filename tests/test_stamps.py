import pytest

from cadencia.operators.stamps import inferred_format, stamp_evidence
from cadencia.plans.jobs import run_can


def column(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string")


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["01/07/2026 05:06:07", "13/07/2026 05:06:07", None, "  "], "d/M/yyyy H:m:s[.SSSSSS]"),
        (["01/07/2026 05:06:07", "07/13/2026 05:06:07.25"], "M/d/yyyy H:m:s[.SSSSSS]"),
        (["2026-07-13 05:06", "2026-07-01 05:06"], "yyyy-M-d H:m"),
        (["5-5-2026", " 6-6-2026 "], "d-M-yyyy"),  # both orders say the same
        ([None, " "], None),
    ],
)
def test_inferred(spark, texts, expected):
    assert inferred_format(column(spark, *texts), "t") == expected


def test_ties_and_mixtures_are_refused(spark):
    with pytest.raises(ValueError, match="d/M/yyyy.* or M/d/yyyy"):
        inferred_format(column(spark, "01/07/2026 05:06:07", "02/07/2026 05:06:07"), "t")
    with pytest.raises(ValueError, match="reads 1 of 2"):
        inferred_format(column(spark, "13/07/2026 05:06:07", "07/13/2026 05:06:07"), "t")
    with pytest.raises(ValueError, match="no format"):
        inferred_format(column(spark, "yesterday"), "t")
    assert inferred_format(spark.createDataFrame([], "t string"), "t") is None
    evidence = {e.format: (e.n_texts, e.n_read) for e in stamp_evidence(column(spark, "01/07/2026", "13/07/2026"), "t").collect()}
    assert evidence["d/M/yyyy"] == (2, 2) and evidence["M/d/yyyy"] == (2, 1)


def test_telemetry_with_months_first(spark, tmp_path):
    from datetime import date

    (tmp_path / "CAN-130726.csv").write_text("Fecha;Empresa;Can Data\n07/13/2026 05:00:00;E1;Volvo  T = 3 h\n07/13/2026 06:00:00;E1;Volvo  T = 4 h\n")
    run_can(spark, str(tmp_path), date(2026, 7, 13), date(2026, 7, 13), str(tmp_path / "out"), formats=["infer"])
    rows = spark.read.parquet(str(tmp_path / "out" / "Volvo")).collect()
    assert sorted((str(r.Fecha)[:10], r.Hora) for r in rows) == [("2026-07-13", "05:00:00"), ("2026-07-13", "06:00:00")]
