"""Hot tied keys, null classes, several blocks, names with dots, report without a label grid."""
import hashlib
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import evaluate, ranking
from tabsmith.operators import split as split_mod
from tabsmith.operators.split import assign_folds, assign_split
from tabsmith.plans.models import build_pipeline, mlp, predict, xgboost


def _md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(split_mod, "prefix_before", partial(ranking.prefix_before, rows_per_block=40))


def test_hot_key_is_split_exactly_over_blocks(spark, small_blocks):
    df = spark.range(400).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    rows = [(0 if i < 300 else i, i) for i in range(400)]
    order = sorted(rows, key=lambda r: (_md5(5, r[0]), *r))
    want = {v for _, v in order[:100]}
    for n in (1, 6):
        got = assign_split(df.repartition(n), 0.25, 5, None, ["k"])
        assert {r["v"] for r in got.where("split = 'test'").collect()} == want


def test_folds_over_several_blocks_keep_null_classes(spark, small_blocks):
    df = spark.range(300).select("id", (F.col("id") % 10).alias("k"), F.expr("CASE WHEN id % 3 > 0 THEN id % 3 END").alias("c"))
    folds = assign_folds(df, 4, 2, "c", ["k"]).collect()
    assert len(folds) == 300
    assert set(Counter((r["c"], r["fold"]) for r in folds).values()) == {25}
    rank = {}
    for c in (None, 1, 2):
        part = [(r["id"], r["k"], r["c"]) for r in folds if r["c"] == c]
        part.sort(key=lambda r: (_md5(2, r[1]), r[0]))
        rank |= {r[0]: i % 4 for i, r in enumerate(part)}
    assert {r["id"]: r["fold"] for r in folds} == rank


def test_report_from_cells_with_labels_on_one_side_only(spark):
    pred = spark.createDataFrame([(0, 0), (0, 0), (1, 2), (1, 1), (None, 1)], "label int, prediction int")
    rows = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in evaluate.classification_report(pred).collect()}
    assert rows["0"] == (1.0, 1.0, 2) and rows["1"] == (1.0, 0.5, 2) and rows["2"] == (0.0, 0.0, 0)
    cells = {(r["label"], r["prediction"]): r["cnt"] for r in evaluate.confusion_cells(pred).collect()}
    assert len(cells) == 9 and cells[(0, 0)] == 2 and cells[(1, 2)] == 1 and cells[(2, 0)] == 0


def test_feature_names_with_dots_train_and_score(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 2), i % 2) for i in range(60)], "`row id` int, `a.b` double, `c_St. A` double, label int")
    model = build_pipeline("gbt", ["a.b", "c_St. A"], ["a.b"], n_estimators=2, max_depth=2).fit(df)
    out = predict(model, df, keep=["row id", "label"]).collect()
    assert len(out) == 60 and all(r["prediction"] == r["label"] for r in out)


def test_models_reject_unknown_parameters():
    for make in (mlp, xgboost):
        with pytest.raises(ValueError, match="dropout"):
            make(dropout=0.1)


def test_blocks_of_order_columns_with_nulls(spark):
    rows = [(None if i % 4 == 0 else i % 5, None if i % 7 == 0 else i % 11, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, i int")
    low = -1
    order = sorted(rows, key=lambda r: (low if r[0] is None else r[0], low if r[1] is None else r[1], r[2]))
    for blocks in (50, 3):
        got = ranking.prefix_before(df, [], ["a", "b", "i"], rows_per_block=10, max_blocks=blocks).collect()
        assert {r["i"]: r["before"] for r in got} == {r[2]: n for n, r in enumerate(order)}


def test_pairing_by_key(spark):
    from tabsmith.operators.pairing import pair_by_key

    features = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    labels = spark.createDataFrame([(2, 0), (1, 1)], "k int, y int")
    assert sorted(map(tuple, pair_by_key(features, labels, ["k"]).collect())) == [(1, "a", 1), (2, "b", 0)]
    for other in ([(1, 1)], [(1, 1), (2, 0), (2, 1)], [(1, 1), (2, 0), (3, 1)], [(1, 1), (None, 0)]):
        with pytest.raises(ValueError):
            pair_by_key(features, spark.createDataFrame(other, "k int, y int"), ["k"])
    with pytest.raises(ValueError):
        pair_by_key(features.selectExpr("CASE WHEN k = 1 THEN 1 END AS k", "x"),
                    labels.selectExpr("CASE WHEN k = 1 THEN 1 END AS k", "y"), ["k"])


def test_folds_by_hash_buckets(spark, monkeypatch):
    """Buckets of the hash, one of them filled by a repeated key; a null class."""
    ranked = []
    plain = split_mod.prefix_before
    monkeypatch.setattr(split_mod, "_BUCKET_ROWS", 9, raising=False)
    monkeypatch.setattr(split_mod, "_FULL_BUCKET", 60, raising=False)
    monkeypatch.setattr(split_mod, "prefix_before", lambda df, *a, **k: ranked.append(df.count()) or plain(df, *a, **k))
    df = spark.range(500).select("id", F.when(F.col("id") < 400, F.col("id")).otherwise(-1).alias("k"), F.expr("CASE WHEN id % 3 > 0 THEN id % 3 END").alias("c"))
    for by, classes in ((None, [None]), ("c", [None, 1, 2])):
        ranked.clear()
        folds = assign_folds(df.repartition(5), 4, 2, by, ["k"]).collect()
        for c in classes:
            part = sorted((_md5(2, r["k"]), r["id"], r["fold"]) for r in folds if by is None or r["c"] == c)
            assert [f for _, _, f in part] == [i % 4 for i in range(len(part))]
        assert len(folds) == 500 and (by or 100 <= ranked[0] < 200)        # only the full bucket is ranked by prefix counts
