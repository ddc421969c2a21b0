"""Quantiles of very many groups, Kendall digits, Spearman with missing values."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabsmith.operators import chartdata, correlation
from tabsmith.operators.quantiles import exact_quantiles, grouped_quantiles


def test_grouped_quantiles_equal_guided_ones(spark):
    df = spark.range(4000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("h"),
                                  ((F.col("id") * 7919) % 1009 / 8.0).alias("v"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    one = {(r.g, r.h): (r.n, list(r.q)) for r in grouped_quantiles(df, ["g", "h"], probs).collect()}
    two = {(r.g, r.h): (r.n, list(r.q)) for r in exact_quantiles(df, ["g", "h"], probs).collect()}
    assert one == two and len(one) > 100


def test_box_stats_of_a_hundred_thousand_classes(spark):
    df = spark.range(300_000).select((F.col("id") % 100_000).alias("c"), (F.col("id") * 3 % 1000).cast("double").alias("v"),
                                     F.lit(None).cast("double").alias("none"))
    got = chartdata.box_stats(df, "c", ["v", "none"])
    assert got.count() == 100_000
    rows = {r["class"]: r for r in got.where("class IN (0, 7, 99999)").collect()}
    for c, r in rows.items():
        v = np.array([i * 3 % 1000 for i in (c, c + 100_000, c + 200_000)], float)
        assert (r.q1, r.median, r.q3) == tuple(np.quantile(v, [0.25, 0.5, 0.75])) and r.n == 3 and r.n_fliers == 0


def test_few_and_many_classes_agree(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") % 5).alias("c"), ((F.col("id") * 37) % 101).alias("v"))
    few = sorted(map(tuple, chartdata.box_stats(df, "c", ["v"]).collect()))
    monkeypatch.setattr(chartdata, "FEW_GROUPS", 1)
    assert sorted(map(tuple, chartdata.box_stats(df, "c", ["v"]).collect())) == few


def test_spearman_with_missing_values_ranks_every_pair(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 200).astype(float), "b": rng.normal(size=200), "c": rng.integers(0, 3, 200).astype(float), "d": 1.0})
    pdf["b"] += pdf["a"]
    for c in ("a", "b", "c"):
        pdf.loc[rng.random(200) < 0.2, c] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, d double")
    want = pdf.corr("spearman")
    jobs = spark.sparkContext.statusTracker()
    for cols in (["a", "b", "c", "d"], ["a", "b"]):
        spark.sparkContext.setJobGroup(f"pairs{len(cols)}", "")
        for r in correlation.spearman_matrix(df, cols, rows_per_block=50).collect():
            expected = want.loc[r.col_x, r.col_y]
            assert (r["corr"] is None) if np.isnan(expected) else abs(r["corr"] - expected) < 1e-12
    spark.sparkContext.setJobGroup("rest", "")
    assert abs(len(jobs.getJobIdsForGroup("pairs4")) - len(jobs.getJobIdsForGroup("pairs2"))) <= 4     # not by the number of pairs


def test_kendall_in_digits_of_several_bits(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.integers(0, 60, 900), "y": rng.integers(0, 50, 900)})
    pdf["y"] = pdf["y"] + pdf["x"] // 3
    df = spark.createDataFrame(pdf)
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    want = (sx * sy).sum() / np.sqrt((sx != 0).sum() * (sy != 0).sum())
    # blocks of 64 cells leave four bits or fewer: one pass of prefix sums
    assert abs(correlation.kendall_pair(df, "x", "y", 64) - want) < 1e-12


def test_large_groups_among_many_are_cut_in_blocks(spark, monkeypatch):
    from tabsmith.operators import quantiles

    df = spark.range(900).select(F.when(F.col("id") < 500, F.lit(-1)).otherwise(F.col("id") % 90).alias("c"),
                                 F.when(F.col("id") % 11 > 0, (F.col("id") * 37) % 101 - 7.0).alias("v"))
    want = sorted(map(tuple, chartdata.box_stats(df, "c", ["v"]).collect()))
    monkeypatch.setattr(chartdata, "FEW_GROUPS", 1)
    plans = {}
    for limit in (10_000, 100):
        monkeypatch.setattr(quantiles, "GROUP_ROWS", limit, raising=False)
        got = chartdata.box_stats(df, "c", ["v"])
        assert sorted(map(tuple, got.collect())) == want
        plans[limit] = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plans[10_000] and "Join" in plans[100]       # small groups: no row is joined
