"""The model keys: which models they train, and a real (small) fit through the same path."""
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tabsmith.plans import models

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


@pytest.mark.parametrize("key, name, params", [("m2_gbt_score", "gbt", {}), ("m3_mlp_score", "mlp", {}),
                                               ("m2_xgboost_score_30_rounds", "xgboost", {"n_estimators": 30})])
def test_model_keys_train_the_default_models(spark, monkeypatch, key, name, params):
    calls = []

    def scored(lineitem, name, **params):
        calls.append((name, params))
        return lineitem.select(*entry.LINEITEM_KEY, F.lit(1).alias("label"), F.lit(0.4).alias("p1"), F.lit(0).alias("prediction"))

    monkeypatch.setattr(models, "score_holdout", scored)
    row = entry.queries()[key](spark, SF).first()
    assert calls == [(name, params)] and row.p_in_range and row.threshold_holds


@pytest.mark.parametrize("name, params", [("xgboost", {"n_estimators": 3, "max_depth": 2}), ("gbt", {"n_estimators": 2, "max_depth": 2}),
                                          ("mlp", {"hidden_layer_sizes": (4,), "max_iter": 2})])
def test_scored_holdout_covers_the_test_split(spark, name, params):
    rows = entry._scored_holdout(spark, SF, name, **params).collect()
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert len(rows) == -(-n * 2 // 10) and all(r.p_in_range and r.threshold_holds for r in rows)
    assert {r.label for r in rows} == {0, 1}
