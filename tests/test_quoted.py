"""Quoted line breaks across byte ranges, against the whole-file reader."""
import random

import pytest
from pyspark.sql import functions as F

from tabsmith.sources import quoted
from tabsmith.sources.loaders import CSVDataLoader


@pytest.fixture
def tiny_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def field(rnd):
    text = "".join(rnd.choice(['a', 'b,', '"', '""', '\n', '\n\n', ' ', 'é', 'x"y', ', "', '5" pipe']) for _ in range(rnd.randint(0, 9)))
    return '"' + text.replace('"', '""') + '"' if rnd.random() < 0.8 or any(c in text for c in '",\n') else text


def write(path, rnd, rows, end="\n"):
    path.write_bytes(end.join(["k,one,two", *[f"{i},{field(rnd)},{field(rnd)}" for i in range(rows)], ""]).encode())


def read(spark, path, **options):
    rows = CSVDataLoader(str(path), null_tokens=[], default_null_tokens=False, strip_whitespace=False, schema="k int, one string, two string").load(spark)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_whole_file_reader(spark, tmp_path, tiny_ranges, seed):
    rnd = random.Random(seed)
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder / "a.csv", rnd, 120)
    write(folder / "b.csv", rnd, 3)
    write(folder / "c.csv", rnd, 0)
    got = read(spark, folder)
    whole = spark.read.options(header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, emptyValue="", nullValue="\x00") \
        .schema("k int, one string, two string").csv(str(folder))
    key = lambda r: (r.k, r.one or "", r.two or "")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert len({key(r) for r in got.collect()}) == 123
    lines = quoted._lines(spark, str(folder))
    assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 10       # several tasks read one file


def test_shuffled_ranges_and_crlf(spark, tmp_path, tiny_ranges, monkeypatch):
    rnd = random.Random(9)
    write(tmp_path / "x.csv", rnd, 60, "\r\n")
    few = sorted(map(tuple, read(spark, tmp_path / "x.csv").collect()))
    monkeypatch.setattr(quoted, "BROADCAST_RANGES", 0)
    assert sorted(map(tuple, read(spark, tmp_path / "x.csv").collect())) == few
    assert [r[0] for r in few] == list(range(60)) and not any((r[2] or "").endswith("\r") for r in few)


def test_one_field_over_many_ranges(spark, tmp_path, tiny_ranges):
    long = "line\n" * 200
    (tmp_path / "y.csv").write_text(f'k,one,two\n1,"{long}",z\n2,"a""b\nc",d"e\n', encoding="utf-8")
    assert sorted(map(tuple, read(spark, tmp_path / "y.csv").collect())) == [(1, long, "z"), (2, 'a"b\nc', 'd"e')]


@pytest.mark.parametrize("line, inside, want", [
    ("a,b", False, False), ('a,"b', False, True), ('b",c', True, False), ('b"",c', True, True), ('a"b,c', False, False),
    ('a, "b', False, True), ('"a""', False, True), ('"a"",b",c', False, False), ('x","y', True, True), ("", True, True)])
def test_state_after_a_line(line, inside, want):
    assert quoted.ends_inside(line, inside) is want


def test_split_query_writes_its_files_side_by_side(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    paths = []
    monkeypatch.setattr(entry, "_scratch", lambda spark, name: paths.append(str(tmp_path / name)) or paths[-1])
    texts = [(i, f'line {i}\n"quoted", {i}' if i % 3 else None, "en") for i in range(40)]
    for part in range(4):
        spark.createDataFrame(texts[part::4], "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["s2_csv_split"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(i, t or "") for i, t, _ in texts] or sorted((r.doc_id, r.text) for r in got) == [(i, t) for i, t, _ in texts]
    assert spark.read.format("binaryFile").load(paths[0] + "/*.csv").count() > 1
