"""Empty and all-missing inputs: no division errors, undefined statistics are null."""

import pytest

from tabsmith.operators import chartdata, correlation, profile, quality
from tabsmith.operators.cleaning import ModeImputer, default_recipe
from tabsmith.operators.encoding import OneHotCategoricalEncoder
from tabsmith.operators.evaluate import binary_metrics
from tabsmith.operators.scaling import StandardNumericalScaler
from tabsmith.operators.split import assign_split

SCHEMA = "age long, fnlwgt long, education string, workclass string, sex string, salary string, x double"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def all_null(spark):
    return spark.createDataFrame([(None, None), (None, None)], "a double, b string")


def test_profile_empty(empty):
    rows = {r["column"]: r for r in profile.numerical_summary(empty).collect()}
    assert rows["age"]["count"] == 0
    assert all(rows["x"][k] is None for k in ("mean", "std", "q50", "skew", "kurtosis"))
    out = {r["column"]: r for r in profile.outlier_summary(empty).collect()}
    assert out["x"]["n_outliers"] == 0 and out["x"]["pct_outliers"] is None
    assert profile.categorical_summary(empty).count() == 0
    assert profile.outliers_iqr(empty, "x").count() == 0


def test_quality_empty(empty):
    s = quality.summary(empty).first()
    assert s["n_rows"] == 0 and s["n_duplicate_rows"] == 0
    assert quality.missing_values_report(empty).count() == 0
    assert {r["unique_values"] for r in quality.cardinality_report(empty).collect()} == {0}


def test_chartdata_and_correlation_empty(empty):
    assert chartdata.histogram(empty, ["x"]).count() == 0
    assert chartdata.box_stats(empty, "salary", ["x"]).count() == 0
    assert chartdata.class_balance(empty, "salary").count() == 0
    for method in ("pearson", "spearman", "kendall"):
        assert [r["corr"] for r in correlation.correlation_matrix(empty, method, ["age", "x"]).collect()] == [None]


def test_preparation_empty(empty):
    assert default_recipe(["fnlwgt"], ["workclass"]).run(empty).count() == 0
    model = OneHotCategoricalEncoder(exclude=["salary"]).fit(empty)
    assert model.transform(empty).count() == 0
    assert StandardNumericalScaler(columns=["age"]).fit_transform(empty).count() == 0
    out = assign_split(empty, 0.2, 1, "salary")
    assert "split" in out.columns and out.count() == 0
    m = binary_metrics(empty.selectExpr("1 as label", "1 as prediction")).first()
    assert m["n"] == 0 and m["accuracy"] == 0.0


def test_all_missing_columns(all_null):
    row = {r["column"]: r for r in profile.numerical_summary(all_null).collect()}["a"]
    assert row["count"] == 0 and row["q25"] is None and row["mean"] is None
    assert quality.constant_columns(all_null) == ["a", "b"]
    out = ModeImputer(["a", "b"])(all_null)
    assert out.where("a is null and b is null").count() == 2
    assert chartdata.histogram(all_null, ["a"]).count() == 0
