import pandas as pd

from tabsmith.operators import quality
from tabsmith.sources.loaders import CSVDataLoader


def test_missing_share_and_repeated_rows_of_a_file(spark, sample_csv):
    df = CSVDataLoader(sample_csv).load(spark)
    (only,) = quality.missing_values_report(df).collect()
    assert (only["column"], only["missing_count"], only["missing_pct"]) == ("roast", 1, 25.0)
    assert quality.duplicate_rows_count(df) == 1


def test_nan_counts_as_missing_and_duplicates_match(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 1), (None, 2), (-0.0, 3), (0.0, 3)],
                               "x double, k int")
    rep = {r["column"]: r["missing_count"] for r in quality.missing_counts(df).collect()}
    assert rep == {"x": 3, "k": 0}
    # NaN = NaN and -0.0 = 0.0 like pandas
    assert quality.duplicate_rows_count(df) == 2


def test_constant_columns_any_type(spark):
    df = spark.createDataFrame([(1, "a", None, 1.0), (1, "b", None, float("nan")), (1, "c", None, 1.0)],
                               "c1 int, c2 string, c3 string, c4 double")
    assert quality.constant_columns(df) == ["c1", "c3", "c4"]


def test_cardinality_desc(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", None), ("a", "y", None)],
                               "s1 string, s2 string, s3 string")
    rows = [(r["column"], r["unique_values"]) for r in quality.cardinality_report(df).collect()]
    assert rows == [("s1", 2), ("s2", 2), ("s3", 0)]
    approx = {r["column"]: r["unique_values"] for r in quality.cardinality_report(df, approx_rsd=0.05).collect()}
    assert approx["s1"] == 2


def test_summary_row(spark, sample_csv):
    df = CSVDataLoader(sample_csv).load(spark)
    s = quality.summary(df).first()
    assert (s["n_rows"], s["n_columns"], s["n_duplicate_rows"]) == (4, 3, 1)
    assert s["columns_with_missing"] == ["roast"]
    # one distinct non-missing level (dark) counts as constant, as in the reference
    assert s["constant_columns"] == ["roast"]


def test_empty_table_no_division_error(spark):
    df = spark.createDataFrame([], "a long, b string")
    rep = quality.missing_counts(df).collect()
    assert all(r["missing_pct"] is None for r in rep)
    assert quality.duplicate_rows_count(df) == 0


def test_against_pandas_random(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 3, 200).astype(float), "b": rng.choice(["x", "y", None], 200)})
    pdf.loc[rng.choice(200, 20, replace=False), "a"] = np.nan
    df = spark.createDataFrame(pdf)
    assert quality.duplicate_rows_count(df) == int(pdf.duplicated().sum())
    rep = {r["column"]: r["missing_count"] for r in quality.missing_counts(df).collect()}
    assert rep == {c: int(v) for c, v in pdf.isna().sum().items()}
