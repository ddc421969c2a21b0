import itertools
import math

import numpy as np
import pandas as pd
import pytest

from tabsmith.operators import correlation


def _brute_kendall(x, y):
    n0 = n1 = n2 = n3 = s = 0
    pairs = [(a, b) for a, b in zip(x, y) if not (np.isnan(a) or np.isnan(b))]
    for (x1, y1), (x2, y2) in itertools.combinations(pairs, 2):
        n0 += 1
        tx, ty = x1 == x2, y1 == y2
        n1 += tx
        n2 += ty
        n3 += tx and ty
        s += np.sign(x2 - x1) * np.sign(y2 - y1)
    den = (n0 - n1) * (n0 - n2)
    return s / math.sqrt(den) if den > 0 else None


def _frame(seed, n=120, nulls=True):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": rng.integers(0, 6, n).astype(float), "b": rng.normal(0, 1, n).round(1),
                        "c": rng.integers(0, 3, n).astype(float)})
    pdf["b"] = pdf["b"] + pdf["a"] * 0.3
    if nulls:
        pdf.loc[rng.choice(n, 10, replace=False), "a"] = np.nan
        pdf.loc[rng.choice(n, 7, replace=False), "b"] = np.nan
    return pdf


@pytest.mark.parametrize("nulls", [False, True])
def test_pearson_and_spearman_match_pandas(spark, nulls):
    pdf = _frame(1, nulls=nulls)
    df = spark.createDataFrame(pdf)
    for method in ["pearson", "spearman"]:
        got = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.correlation_matrix(df, method).collect()}
        ref = pdf.corr(method=method)
        for (x, y), v in got.items():
            assert math.isclose(v, ref.loc[x, y], rel_tol=1e-9, abs_tol=1e-12), (method, x, y)


def test_spearman_forced_blocks(spark):
    pdf = _frame(2, n=300, nulls=False)
    df = spark.createDataFrame(pdf)
    got = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.spearman_matrix(df, rows_per_block=7).collect()}
    ref = pdf.corr(method="spearman")
    for (x, y), v in got.items():
        assert math.isclose(v, ref.loc[x, y], rel_tol=1e-9)


@pytest.mark.parametrize("rows_per_block", [1_000_000, 5, 1])
def test_kendall_matches_brute_force(spark, rows_per_block):
    pdf = _frame(3, n=90)
    df = spark.createDataFrame(pdf)
    got = {(r["col_x"], r["col_y"]): r["corr"]
           for r in correlation.kendall_matrix(df, rows_per_block=rows_per_block).collect()}
    for (x, y), v in got.items():
        ref = _brute_kendall(pdf[x].to_numpy(), pdf[y].to_numpy())
        assert math.isclose(v, ref, rel_tol=1e-12), (x, y, rows_per_block)


def test_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "k double, x double")
    for method in ["pearson", "spearman", "kendall"]:
        r = correlation.correlation_matrix(df, method).first()
        assert r["corr"] is None, method


def test_heatmap_is_symmetric_with_diagonal(spark):
    df = spark.createDataFrame(_frame(4, nulls=False))
    cells = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.heatmap_cells(df).collect()}
    assert len(cells) == 9
    assert cells[("a", "a")] == 1.0
    assert cells[("a", "b")] == cells[("b", "a")]


def test_many_columns_are_chunked_into_passes(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(0, 1, (60, 40)), columns=[f"c{i}" for i in range(40)])
    got = correlation.pearson_matrix(spark.createDataFrame(pdf)).collect()
    assert len(got) == 40 * 39 // 2            # 820 pair sums + 40 squares > one pass
    ref = pdf.corr()
    assert all(math.isclose(r["corr"], ref.loc[r["col_x"], r["col_y"]], rel_tol=1e-9, abs_tol=1e-12) for r in got)


def test_spearman_with_missing_values_copies_no_row_for_its_pairs(spark, monkeypatch):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({c: rng.integers(0, k, 300).astype(float) for c, k in zip("abcde", (4, 9, 200, 30, 2), strict=True)})
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2).assign(f=np.nan)
    df = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in pdf.itertuples(index=False)], ", ".join(f"{c} double" for c in pdf))

    def copied(*args):
        raise AssertionError("rows were copied for their pairs")

    monkeypatch.setattr(correlation, "_complete_pairs", copied)
    want = pdf.corr(method="spearman")
    for tile, values in ((12, 10**6), (2, 0)):             # one pass with small tables sent along; several passes and shuffles
        monkeypatch.setattr(correlation, "TILE", tile)
        monkeypatch.setattr(correlation, "BROADCAST_VALUES", values)
        got = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.spearman_matrix(df, list(pdf), rows_per_block=50).collect()}
        assert len(got) == 15
        for (x, y), v in got.items():
            assert v is None if "f" in (x, y) else v == pytest.approx(want.loc[x, y], abs=1e-9)
