import numpy as np
import pytest

from tabsmith.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("buckets,list_limit", [(1024, 20_000), (4, 3), (2, 1)])
def test_exact_quantiles_match_numpy(spark, buckets, list_limit):
    rng = np.random.default_rng(11)
    a = np.concatenate([rng.normal(0, 1, 300), np.zeros(200), [1e12]])    # ties + an extreme outlier
    b = rng.integers(0, 5, 77).astype(float)
    c = np.array([3.5])
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", float(v)) for v in c]
    long = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(long, ["g"], probs, buckets, list_limit).collect()}
    for g, arr in (("a", a), ("b", b), ("c", c)):
        n, q = got[g]
        assert n == len(arr)
        assert np.allclose(q, np.percentile(arr, [p * 100 for p in probs]), rtol=1e-12, atol=1e-12), g


def test_exact_quantiles_equal_spark_percentile(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    long = spark.createDataFrame([("x", float(v)) for v in rng.gamma(2, 2, 999).round(2)], "g string, v double")
    ours = exact_quantiles(long, ["g"], [0.25, 0.5, 0.75], buckets=8, list_limit=10).first()["q"]
    theirs = long.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert list(ours) == list(theirs)


@pytest.mark.parametrize("buckets,list_limit", [(4096, 20_000), (4, 3), (2, 1)])
def test_column_quantiles_join_no_rows(spark, monkeypatch, buckets, list_limit):
    from tabsmith.operators import quantiles

    rng = np.random.default_rng(5)
    a, b = np.concatenate([rng.normal(0, 1, 400), np.zeros(100)]), rng.integers(0, 9, 500).astype(float)
    b[::7] = np.nan
    df = spark.createDataFrame([(float(x), None if np.isnan(y) else float(y), 2.0, None) for x, y in zip(a, b)],
                               "`a.b` double, b double, c double, d double")
    kept = b[~np.isnan(b)]
    stats = {"a.b": (500, a.min(), a.max()), "b": (len(kept), kept.min(), kept.max()), "c": (500, 2.0, 2.0), "d": (0, None, None)}
    stats = {k: (n, *[x if x is None else float(x) for x in ends]) for k, (n, *ends) in stats.items()}
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    joins = []
    inside = quantiles._in_windows
    monkeypatch.setattr(quantiles, "_in_windows", lambda *args: joins.append(1) or inside(*args))
    got = quantiles.column_quantiles(df, list(stats), probs, stats, buckets, list_limit)
    assert got["a.b"] == pytest.approx(list(np.quantile(a, probs)), abs=1e-12) and got["b"] == list(np.quantile(kept, probs))
    assert got["c"] == [2.0] * 5 and "d" not in got
    assert not joins or list_limit < 20_000
