"""Infinite and very wide values, CSV text, NaN fill, folds under repeated keys."""
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import quantiles
from tabsmith.operators.cleaning import fill_constant
from tabsmith.operators.split import assign_folds
from tabsmith.sources.loaders import CSVDataLoader

WIDE = {"infinity": "CASE WHEN id = 7 THEN double('Infinity') ELSE double(id) END",
        "both": "CASE id WHEN 0 THEN double('-Infinity') WHEN 1 THEN double('Infinity') ELSE double(id % 999) END",
        "overflow": "CASE id WHEN 0 THEN -1.7e308D WHEN 1 THEN 1.7e308D ELSE double(id) / 3 END",
        "lognormal": "exp(double(pmod(xxhash64(id), 1400) - 700))", "signs": "double(id - 15000) * 1e-300D"}


@pytest.mark.parametrize("name", WIDE)
def test_quantiles_of_any_doubles(spark, name):
    long = spark.range(30_000).selectExpr("'c' AS column", f"{WIDE[name]} AS v")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(long, ["column"], probs, list_limit=50).first()["q"]
    values = sorted(r["v"] for r in long.collect())
    for p, q in zip(probs, got, strict=True):
        pos = p * (len(values) - 1)
        a, b = values[int(pos)], values[min(int(pos) + 1, len(values) - 1)]
        assert q == a if pos == int(pos) else a <= q <= b


def test_split_points_are_in_order():
    for a, b in ((-1.0, 1.0), (0.0, 5e-324), (float("-inf"), float("inf")), (1.0, 1.0 + 2**-50)):
        points = quantiles.split_points(a, b, 64)
        assert points == sorted(points) and a <= points[0] and points[0] <= b


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('k,text\n1,"say ""hi"" now"\n2,"two\nlines"\n3\n', encoding="utf-8")
    rows = CSVDataLoader(str(path)).load(spark).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi" now'), (2, "two\nlines"), (3, None)]


def test_csv_surplus_fields_and_bad_values_raise(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("k,text\n1,a\n2,b,EXTRA\n", encoding="utf-8")
    with pytest.raises(Exception, match="more fields"):
        CSVDataLoader(str(path)).load(spark).collect()
    path.write_text("k,text\n1,a\nx,b\n", encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        CSVDataLoader(str(path), schema="k int, text string").load(spark).collect()


def test_fill_constant_fills_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r["x"] for r in fill_constant(df, "x", 9.0).collect()] == [1.0, 9.0, 9.0]


def test_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 20).alias("k"), F.col("id").alias("other"))
    folds = [{r["other"]: r["fold"] for r in assign_folds(df.repartition(n), 3, 1, None, ["k"]).collect()} for n in (2, 7)]
    assert folds[0] == folds[1]
