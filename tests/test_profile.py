import math

import numpy as np
import pandas as pd
import pytest

from tabsmith.operators import chartdata, profile


def _close(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def test_numerical_summary_has_expected_columns(spark):
    df = spark.createDataFrame([(20, 1), (30, 2), (40, 3), (50, 100)], "age long, salary_num long")
    out = profile.numerical_summary(df)
    assert {"mean", "skew", "kurtosis", "q25"} <= set(out.columns)
    assert {r["column"] for r in out.collect()} == {"age", "salary_num"}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_numerical_summary_matches_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x": rng.normal(10, 3, 300), "y": rng.integers(0, 5, 300).astype(float)})
    pdf.loc[rng.choice(300, 30, replace=False), "x"] = np.nan
    df = spark.createDataFrame(pdf)
    got = {r["column"]: r for r in profile.numerical_summary(df).collect()}
    desc = pdf.describe().T
    for c in ["x", "y"]:
        assert got[c]["count"] == desc.loc[c, "count"]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert _close(got[c][ours], float(desc.loc[c, theirs])), (c, ours)
        assert _close(got[c]["skew"], float(pdf[c].skew()))
        assert _close(got[c]["kurtosis"], float(pdf[c].kurt()))


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [1.0, 2.0, 4.0], [5.0, 5.0, 5.0, 5.0, 5.0]])
def test_tiny_and_constant_limits(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = profile.numerical_summary(df).first()
    s = pd.Series(values)
    assert _close(got["std"], float(s.std()))
    assert _close(got["skew"], float(s.skew()))
    assert _close(got["kurtosis"], float(s.kurt()))


def test_outliers_iqr_flags_extreme_value(spark):
    df = spark.createDataFrame([(v,) for v in [10, 11, 12, 13, 14, 1000]], "value long")
    out = [r["value"] for r in profile.outliers_iqr(df, "value").collect()]
    assert out == [1000]


def test_outlier_summary_over_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 11, 12, 13, 14, 1000]] + [(None,)], "value double")
    r = profile.outlier_summary(df).first()
    assert r["n_outliers"] == 1 and math.isclose(r["pct_outliers"], 100 / 7)


def test_top_n_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",), ("c",)], "s string")
    rows = [(r["value"], r["cnt"], r["rank"]) for r in profile.categorical_summary(df, 2).orderBy("rank").collect()]
    assert rows == [("a", 2, 1), ("b", 2, 2)]


def test_class_distribution(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (1,)], "y int")
    rows = [(r["value"], r["cnt"], r["share"]) for r in profile.class_distribution(df, "y").collect()]
    assert rows == [("1", 3, 0.75), ("0", 1, 0.25)]


def test_histogram_matches_numpy_auto(spark):
    rng = np.random.default_rng(5)
    x = rng.gamma(2.0, 3.0, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = chartdata.histogram(df, ["x"]).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins="auto")
    assert [r["cnt"] for r in rows] == counts.tolist()
    assert np.allclose([r["lo"] for r in rows], edges[:-1])


def test_box_stats_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(float(v), "a") for v in vals], "v double, t string")
    r = chartdata.box_stats(df, "t", ["v"]).first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r["q1"], r["median"], r["q3"]) == (q1, med, q3)
    assert r["whislo"] == 1 and r["whishi"] == 8 and r["n_fliers"] == 1


def test_density_integrates_to_about_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 2000)], "x double")
    rows = chartdata.density_curve(df, ["x"]).collect()
    xs = np.array([r["x"] for r in rows])
    ys = np.array([r["density"] for r in rows])
    assert len(rows) == 200
    assert 0.9 < np.trapezoid(ys, xs) < 1.01


def test_density_equals_the_sum_over_all_values_with_a_far_one(spark):
    rng = np.random.default_rng(5)
    v = np.append(rng.normal(3, 2, 3000), 5000.0)
    df = spark.createDataFrame([(float(x), "k") for x in v], "x double, other string")
    rows = chartdata.density_curve(df, ["x"]).collect()
    bw = v.std(ddof=1) * len(v) ** -0.2
    for r in rows:
        exact = np.exp(-0.5 * ((r["x"] - v) / bw) ** 2).sum() / (len(v) * bw * np.sqrt(2 * np.pi))
        assert abs(r["density"] - exact) <= 1e-10 / (bw * np.sqrt(2 * np.pi))
    assert [r["i"] for r in rows] == list(range(200))


def test_density_leaves_out_columns_without_a_curve(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 1.0), (float("inf"), 2.0, None, 3.0)], "a double, b double, c double, d double")
    assert {r["column"] for r in chartdata.density_curve(df).collect()} == {"d"}


def test_histogram_of_a_wide_range_without_empty_bins(spark):
    df = spark.createDataFrame([(i / 100,) for i in range(100)] + [(1e12,), (None,)], "x double")
    rows = chartdata.histogram(df, ["x"], empty_bins=False).collect()
    assert sum(r["cnt"] for r in rows) == 101 and all(r["cnt"] > 0 for r in rows)
    assert len(rows) < 10 and max(r["hi"] for r in rows) == 1e12      # the rule asks for about 5e12 bins
    with pytest.raises(ValueError):
        chartdata.histogram(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), ["x"]).collect()


def test_profile_caches_only_the_profiled_columns(spark, monkeypatch):
    from contextlib import contextmanager

    seen = []

    @contextmanager
    def record(df):
        seen.append(df.columns)
        yield df

    monkeypatch.setattr(profile, "materialized", record)
    df = spark.createDataFrame([(1.0, "k", 2)], "x double, s string, n int")
    profile.numerical_summary(df, ["x", "n"]).collect()
    assert seen == [["x", "n"]]
