import os
from datetime import date, datetime, time

import pytest
from pyspark.sql import functions as F

from cadencia.functions import shifts
from cadencia.operators.fleet import fleet_snapshot, stamp_snapshot
from cadencia.operators.trips import typed_trips
from cadencia.plans.jobs import TripTables, run_fleet, run_landing, run_trips
from cadencia.schemas import TRIP_FIELDS, trip_schema
from cadencia.sources.landing import landed
from cadencia.sources.reports import expected_or_newest, read_schedule_extract, read_text_columns, read_trip_report
from cadencia.sources.sinks import append_table, output_path, read_processed_csv, write_csv

HEAD = ";".join(f.header for f in TRIP_FIELDS)


def trip_line(day="01/07/2026", route="L1", vehicle="12", planned="05:00:00", actual="05:01:00", status="1"):
    values = {"Fecha": day, "Ruta": route, "Vehiculo real": vehicle, "Partida Planeada": planned,
              "Partida Real": actual, "Diff Partida": "-00:01:00", "Status del Viaje": status, "Conductor": "Núñez"}
    return ";".join(values.get(f.header, "") for f in TRIP_FIELDS)


def report(path, *lines, trailing=""):
    path.write_bytes("\n".join(f"{line}{trailing}" for line in (HEAD, *lines)).encode("latin-1"))
    return str(path)


def test_trip_report(spark, tmp_path):
    path = report(tmp_path / "RV_1.csv", trip_line(), trip_line(route="NA", actual="-"), trailing=";")
    rows = read_trip_report(spark, path).orderBy("Partida Real").collect()
    assert [r["Conductor"] for r in rows] == ["Núñez", "Núñez"]
    assert rows[0]["Partida Real"] == "-" and rows[0]["Ruta"] is None and rows[1]["Económico planificado"] is None
    report(tmp_path / "RV_2.csv", trip_line(route="L2"), trailing=";")
    both = read_trip_report(spark, str(tmp_path / "RV_*.csv"))
    assert len(both.columns) == len(TRIP_FIELDS) and both.count() == 3
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(RuntimeError, match="empty"):
        read_trip_report(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        read_trip_report(spark, str(tmp_path / "none.csv"))


def test_files_with_differing_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("y;x\n1;2\n")
    with pytest.raises(Exception, match="header"):
        read_text_columns(spark, str(tmp_path / "*.csv"), ";", "UTF-8").collect()


def test_processed_csv_keeps_values(spark, tmp_path):
    raw = read_trip_report(spark, report(tmp_path / "RV_1.csv", trip_line(), trip_line(actual="-", status="2")))
    trips = typed_trips(raw).withColumn("CONDUCTOR", F.lit(' dos\nlíneas, "y" coma'))
    write_csv(trips, str(tmp_path / "out"))
    back = read_processed_csv(spark, str(tmp_path / "out"), trip_schema())
    assert sorted(map(str, back.collect())) == sorted(map(str, trips.collect()))
    assert {r.PARTIDA_REAL for r in back.collect()} == {time(5, 1), None}


def test_bad_processed_row_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,t\n1,05:00:00\nx,05:00:00\n")
    from pyspark.sql.types import LongType, StructField, StructType, TimeType

    schema = StructType([StructField("a", LongType()), StructField("t", TimeType())])
    with pytest.raises(Exception):
        read_processed_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    (tmp_path / "bad.csv").write_text("a,t\n1,25:00:00\n")
    with pytest.raises(Exception, match="not a time of day"):
        read_processed_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_output_path():
    assert output_path("/out", "TRIPS", "/in/RV_sem28_060726.csv") == "/out/TRIPS/TRIPS_sem28_060726"


def test_expected_or_newest(spark, tmp_path):
    for i, name in enumerate(("Desinc_old.csv", "Desinc_new.csv", "other.csv")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    pick = lambda name: expected_or_newest(spark, str(tmp_path), name, "Desinc_*.csv").rsplit("/", 1)[-1]
    assert pick("Desinc_old.csv") == "Desinc_old.csv"
    assert pick("Desinc_none.csv") == "Desinc_new.csv"
    with pytest.raises(FileNotFoundError):
        expected_or_newest(spark, str(tmp_path), "a", "b_*.csv")


def test_landing_skips_known_names(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "landed")
    raw.mkdir()
    (raw / "a.csv").write_bytes("Uno;Año\n01;ñ\n".encode("latin-1"))
    land = lambda: run_landing(spark, f"{raw}/*.csv", "withdrawals", date(2026, 7, 1), target)
    assert land() == ["a.csv"] and land() == []
    (raw / "b.csv").write_bytes("Uno;Año\n02;é\n".encode("latin-1"))
    assert land() == ["b.csv"]
    rows = {r.source_file: (r["Uno"], r["Año"], r.window_start) for r in landed(spark, target, "withdrawals").collect()}
    assert rows == {"a.csv": ("01", "ñ", date(2026, 7, 1)), "b.csv": ("02", "é", date(2026, 7, 1))}
    with pytest.raises(ValueError):
        run_landing(spark, str(raw), "unknown", date(2026, 7, 1), target)


def test_corrected_and_equally_named_files_are_landed(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "landed")
    for folder in ("x", "y"):
        (raw / folder).mkdir(parents=True)
        (raw / folder / "a.csv").write_text(f"p;;q\n1;{folder};2\n")
    land = lambda: run_landing(spark, f"{raw}/*/*.csv", "withdrawals", date(2026, 7, 1), target)
    assert land() == ["a.csv", "a.csv"] and land() == []
    rows = landed(spark, target, "withdrawals").collect()
    assert sorted((r.p, r["_c1"], r.q) for r in rows) == [("1", "x", "2"), ("1", "y", "2")]
    (raw / "x" / "a.csv").write_text("p;;q\n9;corrected;2\n8;more;2\n")
    os.utime(raw / "x" / "a.csv", (1_900_000_000, 1_900_000_000))
    assert land() == ["a.csv"]
    newest = sorted(r["_c1"] for r in landed(spark, target, "withdrawals").collect())
    assert newest == ["corrected", "more", "y"]
    assert landed(spark, target, "withdrawals", versions="all").count() == 4


def test_append_refuses_other_columns(spark, schema):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    append_table(df, f"{schema}.t")
    for odd in (df.withColumn("c", F.lit(1)), df.drop("a"), df.withColumn("a", F.lit("1"))):
        with pytest.raises(ValueError, match="do not fit"):
            append_table(odd, f"{schema}.t")
    append_table(df.select("b", "a"), f"{schema}.t")
    assert spark.table(f"{schema}.t").count() == 2


def test_fleet(spark, tmp_path, schema):
    (tmp_path / "extract.csv").write_text("Ruta;Jornada;Económico;Empresa Programado;Empresa Real\nL1;5;007;A;B\nL2;x;8;A;\n")
    extract = read_schedule_extract(spark, str(tmp_path / "extract.csv"))
    stamped = stamp_snapshot(extract, date(2026, 7, 1), shifts.clock_shift(F.lit(0)))
    assert stamped.columns[:2] == ["Date", "Turno"]
    assert fleet_snapshot(stamped).count() == 2
    write_csv(stamped, str(tmp_path / "stamped"))
    assert run_fleet(spark, str(tmp_path / "absent.csv")) is None
    for _ in range(2):
        snapshot = run_fleet(spark, f"{tmp_path}/stamped/*.csv", f"{schema}.fleet")
    first = snapshot.orderBy("ruta").collect()
    assert (first[0].date, first[0].turno, first[0].jornada, first[0].economico) == (datetime(2026, 7, 1), "Vespertino", 5, "007")
    assert first[1].jornada is None and first[1].empresa_real is None
    assert spark.table(f"{schema}.fleet").count() == 4
    append_table(snapshot.select(*reversed(snapshot.columns)), f"{schema}.fleet")
    assert spark.table(f"{schema}.fleet").filter("ruta = 'L1'").count() == 3


def test_trips_job(spark, schema, tmp_path):
    lines = [trip_line(actual=f"{h:02d}:{m:02d}:00", planned=f"{h:02d}:{m:02d}:30", vehicle=str(v))
             for h in range(5, 9) for m, v in ((0, 10), (20, 11), (40, 12))]
    lines.append(trip_line(actual="-", status="2"))
    path = report(tmp_path / "RV_sem27.csv", *lines)
    tables = TripTables(f"{schema}.trips", f"{schema}.headways", f"{schema}.gaps")
    window = datetime(2026, 6, 29, 3, 20), datetime(2026, 7, 6, 3, 20)
    for _ in range(2):
        written = run_trips(spark, path, *window, tables, str(tmp_path / "landed"), remove_outliers=False)
    assert written == {tables.trips: 13, tables.headways: 11, tables.gaps: 4}
    assert spark.table(tables.trips).count() == 13 and spark.table(tables.headways).count() == 11
    assert {r.INTERVALO_SEC for r in spark.table(tables.gaps).filter("HORA > 5").collect()} == {600.0}
    with pytest.raises(RuntimeError, match="outside"):
        run_trips(spark, path, window[1], datetime(2026, 7, 13, 3, 20), tables, str(tmp_path / "landed"))
    assert spark.table(tables.trips).count() == 13
