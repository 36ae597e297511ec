"""CSV records across byte ranges, next to Spark's own reader, which reads a file with line breaks in one task."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadencia.sources import reports
from cadencia.sources.records import column_names, ends_quoted, header_fields, read_records


@pytest.fixture
def split_size(spark):
    """Sets how many bytes a range has."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def use(n):
        for key, value in zip(keys, (n, 0)):
            spark.conf.set(key, str(value))

    yield use
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


def made_up(rng, path, encoding):
    def value():
        kind = rng.randrange(8)
        if kind < 3:
            return rng.choice(["", "a", "é1", "xy z"])
        if kind == 3:
            return 'in"side'
        return '"' + "".join(rng.choice(["a", ";", "\n", '""', "\r\n", "é", "\n" * 30]) for _ in range(rng.randrange(9))) + '"'

    lines = ['k;"he\nad";;v']
    for i in range(20 + rng.randrange(20)):
        lines.append(";".join([f"{path.name}-{i}", *(value() for _ in range(rng.choice([3, 3, 3, 2, 4])))]))
        lines += [""] * (rng.random() < 0.05)
    path.write_bytes(("\n".join(lines) + rng.choice(["", "\n"])).encode(encoding))


@pytest.mark.parametrize("encoding, size", [("ISO-8859-1", 60), ("UTF-8", 700)])
def test_as_read_by_one_task(spark, tmp_path, split_size, encoding, size):
    rng = random.Random(size)
    for i in range(3):
        made_up(rng, tmp_path / f"f{i}.csv", encoding)
    expected = reports._whole_files(spark, [str(tmp_path)], ";", encoding, True, {})
    wanted = Counter(tuple(r) for r in expected.collect())
    split_size(size)
    found = reports.read_text_columns(spark, str(tmp_path), ";", encoding, unnamed=True)
    assert found.columns == ["k", "he\nad", "_c2", "v"]
    assert Counter(tuple(r) for r in found.collect()) == wanted


def test_one_file_is_read_by_many_tasks(spark, tmp_path, split_size):
    rows = "".join(f'{i};"line {i}\n;""quoted""\n"\n' for i in range(3000))
    (tmp_path / "a.csv").write_text("n;text\n" + rows)
    split_size(4000)
    df = reports.read_text_columns(spark, str(tmp_path / "a.csv"), ";", "UTF-8", origin={"file": F.col("_metadata.file_name")})
    tasks = df.withColumn("task", F.spark_partition_id())
    assert tasks.select("task").distinct().count() > 10
    assert {(r.n, r.text, r.file) for r in df.collect()} == {(str(i), f'line {i}\n;"quoted"\n', "a.csv") for i in range(3000)}


def test_a_record_longer_than_many_ranges(spark, tmp_path, split_size):
    long = "\n".join(f"line {i};" for i in range(500))
    (tmp_path / "a.csv").write_text(f'a;b\n1;"{long}"\n2;x\n"{long}";y\n')
    split_size(400)
    found = reports.read_text_columns(spark, str(tmp_path), ";", "UTF-8").collect()
    assert {(r.a, r.b) for r in found} == {("1", long), ("2", "x"), (long, "y")}


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfx;"y;z"\r\n1;2\r\n')
    (tmp_path / "b.csv").write_bytes(b'"x";"y;z"\n3;4')
    (tmp_path / "empty.csv").write_bytes(b"")
    rows = reports.read_text_columns(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "empty.csv")], ";", "UTF-8")
    assert rows.columns == ["x", "y;z"] and {tuple(r) for r in rows.collect()} == {("1", "2"), ("3", "4")}
    (tmp_path / "c.csv").write_bytes(b"x;other\n5;6\n")
    with pytest.raises(Exception, match="header of .*c.csv differs"):
        reports.read_text_columns(spark, str(tmp_path / "*.csv"), ";", "UTF-8").collect()
    assert column_names(["A", "", "a", "b"]) == ["A0", "_c1", "a2", "b"]
    assert header_fields('"a\nb";é'.encode("latin-1"), ";", "ISO-8859-1") == ["a\nb", "é"]


def test_files_in_halves_if_many_ranges_are_open(spark, tmp_path, split_size):
    for i in range(4):
        (tmp_path / f"f{i}.csv").write_text("a;b\n" + "".join(f'{i}-{j};"x\ny\nz"\n' for j in range(40)))
    split_size(100)
    found = read_records(spark, str(tmp_path), ";", max_ranges=3)
    assert {bytes(r.record) for r in found.collect()} == {f'{i}-{j};"x\ny\nz"'.encode() for i in range(4) for j in range(40)}


def test_quoted_states():
    sep = b";"
    for line, quoted, expected in (
        (b"a;b", False, False), (b'"a', False, True), (b'"a"', False, False), (b'a"b', False, False), (b'"a""', False, True),
        (b'"a";"b', False, True), (b'"a"x;"', False, True), (b"a", True, True), (b'a"', True, False), (b'a"";"', True, False), (b'";"', True, True), (b"", True, True),
    ):
        assert ends_quoted(line, sep, quoted) is expected, (line, quoted)
