from datetime import date

import pytest
from pyspark.sql import functions as F

from cadencia.operators.can_text import brand_counts, branded_rows, parse_can, squeezed, valid_rows
from cadencia.operators.can_wide import can_long, can_wide, layouts, unit_profile
from cadencia.plans.jobs import run_can
from cadencia.schemas import BRANDS


def can(spark, texts, brand=None):
    df = spark.createDataFrame([(t, "E1", "01/07/2026 05:06:07") for t in texts], "`Can Data` string, Empresa string, Fecha string")
    return df.withColumn("brand", F.lit(brand)) if brand else df


def parsed(spark, text):
    row = parse_can(can(spark, [text])).first().asDict()
    return {k: v for k, v in row.items() if v is not None and k not in ("Empresa", "Fecha", "Marca", "pairs")} | row["pairs"], row["Marca"]


@pytest.mark.parametrize(
    "text, brand, fields",
    [
        ("Volvo  RPM = 900 rpm  Tanque 1 y 2 = 8.1 y 07 KPA", "Volvo", {"RPM": "900 rpm", "Tanque_1_kPa": "8.1 KPA", "Tanque_2_kPa": "7.0 KPA"}),
        ("BYD  Temperatura Baterias = 21 min, 35 max", "BYD", {"Temp_Bat_Min": 21.0, "Temp_Bat_Min_Tipo": "min", "Temp_Bat_Max": 35.0, "Temp_Bat_Max_Tipo": "max"}),
        ("Yutong  Temperatura Baterias = 30 °C, SOC = 80 %", "Yutong", {"Temp_Bat": 30.0, "Temp_Bat_Unidad": "°C", "SOC": "80 %"}),
        ("Mercedes  Condicion de Frenos : Del_D = 1, Del_I = 2, Tra_D1 = 3, Tra_I1 = 4, Tra_D2 = 5, Tra_I2 = 6", "Mercedes",
         {"Freno_Del_D": 1.0, "Freno_Del_I": 2.0, "Freno_Tra_D1": 3.0, "Freno_Tra_I1": 4.0, "Freno_Tra_D2": 5.0, "Freno_Tra_I2": 6.0}),
        ("ADennis  ALARM Motor = ok, Battery = ok, Air = low  ALARM Steering = ok, Brake = low", "ADennis",
         {"ALARM_Motor": "ok", "ALARM_Battery": "ok", "ALARM_Air": "low", "ALARM_Steering": "ok", "ALARM_Brake": "low"}),
        ("Scania  , Horas = 12.5, Total Fuel usado = 900.1", "Scania", {"Horas": 12.5, "Total_Fuel_Litros": 900.1}),
        ("Volvo a = 1", "Volvo", {"a": "1"}),
        ("Volvo  a = 1  a = 2  b  c = x=y  = 3  12 = 4  ,d = 5,", "Volvo", {"a": "2", "c": "x=y", "d": "5"}),
        ("Otra Marca  k\t=\r\nv", "Otra Marca", {"k": "v"}),
        ("Desconocida", "Desconocida", {}),
        ("Volvo  Tanque 1 y 2 = 1..2 y 3 kPa", "Volvo", {"Tanque_2_kPa": "3.0 kPa"}),
    ],
)
def test_grammar(spark, text, brand, fields):
    got, marca = parsed(spark, text)
    assert marca == brand
    assert got == fields


def test_letters_digits_and_case_beyond_ascii(spark):
    text = "Volvo  temperatura BATERIAS = 21 mi\u0301n, 35 \u24b6x  ALARM Motor = o\u00aa, Battery = \u203f, Air = no\u00bd"
    got, _ = parsed(spark, text)
    assert got == {"Temp_Bat_Min": 21.0, "Temp_Bat_Min_Tipo": "mi\u0301n", "Temp_Bat_Max": 35.0, "Temp_Bat_Max_Tipo": "\u24b6x",
                   "ALARM_Motor": "o\u00aa", "ALARM_Battery": "\u203f", "ALARM_Air": "no"}


def test_a_text_is_parsed_in_one_pass(spark):
    plan = parse_can(can(spark, ["Volvo  a = 1"])).filter("ALARM_Brake IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract" not in plan and "locate" not in plan


def test_whitespace(spark):
    rows = can(spark, ["  a \t b\n\nc  ", None, "   "]).select(squeezed(F.col("`Can Data`")).alias("v")).collect()
    assert [r.v for r in rows] == ["a  b c", "", ""]


def test_filter_on_parsed_fields_keeps_the_plan_small(spark):
    hit = parse_can(can(spark, ["Volvo  x = 1  ALARM Steering = ok, Brake = low"])).filter("ALARM_Brake = 'low' AND pairs['x'] = '1'")
    assert hit.count() == 1


def test_rows_and_brands(spark):
    df = can(spark, ["List 1", "Error", None, "Volvo  a = 1", "Mercurio", "volvo", "Merc"])
    assert valid_rows(df).count() == 5
    assert {r.brand for r in branded_rows(df).collect()} == {"Volvo", "Mercedes Benz"}
    counts = {r.brand: r.n_rows for r in brand_counts(df).collect()}
    assert counts == {b.name: 0 for b in BRANDS} | {"Volvo": 1, "Mercedes Benz": 2}


def wide(spark, texts, drop=()):
    rows = parse_can(can(spark, texts, "Volvo"))
    (layout,) = layouts(rows)
    return can_wide(rows, layout.profiles, drop)


def test_unit_share_is_strict(spark):
    at_80 = wide(spark, ["Volvo  t = 5 h"] * 8 + ["Volvo  t = x"] * 2)
    assert "t" in at_80.columns
    above = wide(spark, ["Volvo  t = 5 h"] * 9 + ["Volvo  t = x"] * 2)
    assert "t (h)" in above.columns
    assert sorted(r["t (h)"] or 0 for r in above.collect()) == [0, 0] + [5] * 9


def test_halves_go_to_even_and_unit_ties_to_the_smallest(spark):
    df = wide(spark, ["Volvo  t = 2.5 m", "Volvo  t = 3.5 h", "Volvo  u = 1"])
    assert "t (h)" in df.columns and "u" in df.columns
    assert sorted(r["t (h)"] for r in df.collect() if r["t (h)"] is not None) == [2, 4]


def test_key_named_like_a_field_wins(spark):
    df = wide(spark, ["Volvo  Horas = 5 h", "Volvo  Horas = 7 h", "Volvo  Empresa = z  Fecha = hoy"])
    assert sorted(r["Horas (h)"] or 0 for r in df.collect()) == [0, 5, 7]
    assert {"can_Empresa", "can_Fecha", "Empresa", "Fecha", "Hora"} <= set(df.columns)
    mixed = wide(spark, ["Volvo  Horas = 5 h", "Volvo  Horas = 12.5, Total Fuel usado = 9"])
    assert sorted(r["Horas"] for r in mixed.collect()) == ["12.5", "5 h"]


def test_drop_names_follow_the_unit(spark):
    df = wide(spark, ["Volvo  Torque Actual = 5 %"], drop=("Torque Actual (%)", "Marca", "absent"))
    assert df.columns == ["Fecha", "Hora", "Empresa"]


def test_long_form_holds_any_number_of_keys(spark):
    rows = parse_can(can(spark, ["Volvo  " + "  ".join(f"k{i} = {i} h" for i in range(3000))], "Volvo").withColumn("id", F.lit("1")))
    long = can_long(rows, ["id"]).filter("column like 'k%'")
    assert {r.column: r.value for r in long.collect()} == {f"k{i}": f"{i} h" for i in range(3000)}


def test_long_numbers_keep_their_digits(spark):
    texts = ["Volvo  Tanque 1 y 2 = 123456789012345678901234567890.50 y 0.0000000000001 kPa", "Volvo  Tanque 1 y 2 = 007. y 1..2 kPa"]
    got = [(r.Tanque_1_kPa, r.Tanque_2_kPa) for r in parse_can(can(spark, texts)).collect()]
    assert got == [("123456789012345678901234567890.5 kPa", "0.0000000000001 kPa"), ("7.0 kPa", None)]


def test_profile_counts(spark):
    rows = parse_can(can(spark, ["Volvo  t = 5 h", "Volvo  t = x", "Volvo  t = 6 h"], "Volvo"))
    t = unit_profile(rows).filter("column = 't'").first()
    assert (t.n_values, t.n_with_unit, t.unit) == (3, 2, "h")


def test_range_of_days(spark, tmp_path):
    head = "Fecha;Empresa;Can Data\n"
    (tmp_path / "CAN-010726.csv").write_bytes(
        (head + '01/07/2026 05:00:00;E1;"Volvo  T = 30 °C\n  RPM = 9 rpm"\n01/07/2026 06:00:00;E1;BYD  SOC = 80 %\nx;E1;List\n').encode("latin-1")
    )
    (tmp_path / "CAN-030726.csv").write_bytes((head + "03/07/2026 05:00:00;E1;Volvo  T = alta\n").encode("latin-1"))
    (tmp_path / "CAN-020726.csv").write_bytes(b"")
    out = str(tmp_path / "out")
    for _ in range(2):
        summary, skipped = run_can(spark, str(tmp_path), date(2026, 7, 1), date(2026, 7, 4), out)
    assert skipped == [date(2026, 7, 2), date(2026, 7, 4)]
    counts = {(r.report_day.day, r.brand): r.n_rows for r in summary.collect()}
    assert len(counts) == 12 and counts[1, "Volvo"] == counts[1, "BYD"] == counts[3, "Volvo"] == 1
    assert sum(counts.values()) == 3
    volvo = spark.read.option("mergeSchema", "true").parquet(f"{out}/Volvo")
    rows = {r.report_day.day: r.asDict() for r in volvo.collect()}
    assert len(rows) == volvo.count() == 2
    assert rows[1]["T (°C)"] == 30 and rows[1]["RPM (rpm)"] == 9 and rows[3]["T"] == "alta"
    assert rows[1]["Hora"] == "05:00:00" and "Marca" not in rows[1]


def test_rows_are_dealt_out_before_their_texts_are_made(spark, tmp_path):
    from checks.views import can_rows

    spark.range(500).selectExpr(
        "id AS l_orderkey", "CAST(id % 7 + 1 AS int) AS l_linenumber", "id % 11 AS l_suppkey", "2.0D AS l_quantity", "0.05D AS l_discount",
        "TIMESTAMP_NTZ'1995-03-01 00:00:00' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = can_rows(spark, str(tmp_path), F.col("l_orderkey") % 30)
    plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert any("Velocidad" in line for line in plan[:at]) and not any("Velocidad" in line for line in plan[at:])
    per_task = rows.select((F.col("l_orderkey") % 30).alias("d"), F.spark_partition_id().alias("t")).distinct()
    assert per_task.groupBy("d").count().filter("count > 1").isEmpty()
