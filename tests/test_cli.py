import pytest

from cadencia.__main__ import main


def test_jobs_from_the_command_line(spark, schema, tmp_path, capsys):
    trips = spark.sql(
        "SELECT TIMESTAMP_NTZ'2026-07-01' AS FECHA, 'L1' AS RUTA, TIME'05:00:00' AS PARTIDA_PLANEADA "
        "UNION ALL SELECT TIMESTAMP_NTZ'2026-07-01', 'L1', TIME'06:00:00'"
    )
    trips.write.saveAsTable(f"{schema}.trips")
    assert main(["rebuild", f"{schema}.trips", f"{schema}.gaps"]) == 0
    assert spark.table(f"{schema}.gaps").first().INTERVALO_SEC == 1800.0
    assert main(["audit", f"gaps={schema}.gaps,{schema}.gaps", "--cutoff", "2026-07-01"]) == 0
    assert main(["audit", f"x={schema}.gaps,{schema}.trips", "--cutoff", "2026-07-01"]) == 2
    assert main(["can", str(tmp_path), str(tmp_path / "out"), "--first", "2026-07-01"]) == 0
    assert main(["fleet", str(tmp_path / "none.csv")]) == 0
    (tmp_path / "w.csv").write_text("a;b\n1;2\n")
    land = ["land", "operators", str(tmp_path / "w.csv"), "--window-start", "2026-07-03", "--landing", str(tmp_path / "l")]
    assert main(land) == 0 and main(land) == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "w.csv").write_text("a;b\n1;2\n")
    pick = ["land", "withdrawals", str(tmp_path / "in"), "--landing", str(tmp_path / "l"), "--pattern", "w*.csv"]
    assert main([*pick, "--expected", "today.csv"]) == 0
    printed = capsys.readouterr().out
    assert "skipped: 2026-07-01" in printed and "landed: w.csv" in printed and "nothing new" in printed
    assert printed.count("landed: w.csv") == 2
    with pytest.raises(ValueError):
        main(pick)
