import math

from tabsmith.operators.evaluate import Evaluator, binary_metrics, classification_report, confusion_cells


def _pred(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int")


def test_binary_metrics_closed_form(spark):
    df = _pred(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)])
    m = binary_metrics(df).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (2, 1, 1, 1)
    assert math.isclose(m["accuracy"], 0.6) and math.isclose(m["precision"], 2 / 3)
    assert math.isclose(m["recall"], 2 / 3) and math.isclose(m["f1"], 2 / 3)


def test_zero_division_gives_zero(spark):
    m = binary_metrics(_pred(spark, [(0, 0), (0, 0)])).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_zero_filled(spark):
    cells = {(r["label"], r["prediction"]): r["cnt"] for r in confusion_cells(_pred(spark, [(1, 1), (0, 1)])).collect()}
    assert cells == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}


def test_report_rows(spark):
    rep = {r["class"]: r for r in classification_report(_pred(spark, [(1, 1), (1, 0), (0, 0), (0, 0)])).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert math.isclose(rep["0"]["precision"], 2 / 3) and rep["1"]["recall"] == 0.5
    assert rep["accuracy"]["f1"] == 0.75 and rep["weighted avg"]["support"] == 4


def test_evaluator_compare_and_best(spark):
    ev = Evaluator()
    ev.evaluate("a", _pred(spark, [(1, 1), (0, 1)]))
    ev.evaluate("b", _pred(spark, [(1, 1), (0, 0)]))
    assert ev.best() == "b"
    assert [r["model"] for r in ev.compare(spark).orderBy("run_order").collect()] == ["a", "b"]
    assert ev.confusion_frame(spark).count() == 8


def test_model_metrics_one_pass_matches_single_model(spark):
    from tabsmith.operators.evaluate import model_metrics

    df = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (0, 1, 1), (0, 0, 0), (1, 1, 1)], "label int, a int, b int")
    rows = model_metrics(df, "label", ["a", "b"]).orderBy("run_order").collect()
    assert [r["model"] for r in rows] == ["a", "b"]
    for r in rows:
        single = binary_metrics(df.select("label", df[r["model"]].alias("prediction"))).first()
        for k in ("n", "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"):
            assert math.isclose(r[k], single[k]), (r["model"], k)


def test_model_metrics_zero_division_and_names(spark):
    import pytest
    from pyspark.sql import functions as F

    from tabsmith.operators.evaluate import model_metrics

    df = _pred(spark, [(1, 1), (0, 0)])
    m = model_metrics(df, "label", {"never": F.lit(0)}).first()
    assert (m["tp"], m["fn"], m["tn"], m["precision"], m["recall"], m["f1"]) == (0, 1, 1, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        model_metrics(df, "label", [])
    with pytest.raises(ValueError):
        model_metrics(df, "label", [("x", "prediction"), ("x", "label")])


def test_model_confusion_cells_and_best(spark):
    from tabsmith.operators.evaluate import best_model, model_confusion, model_metrics

    df = spark.createDataFrame([(1, 1, 1), (0, 1, 0), (1, 0, 1), (0, 0, 0)], "label int, a int, b int")
    cells = {(r["model"], r["label"], r["prediction"]): r["cnt"]
             for r in model_confusion(df, "label", ["a", "b"]).collect()}
    assert cells == {("a", 0, 0): 1, ("a", 0, 1): 1, ("a", 1, 0): 1, ("a", 1, 1): 1,
                     ("b", 0, 0): 2, ("b", 0, 1): 0, ("b", 1, 0): 0, ("b", 1, 1): 2}
    assert best_model(model_metrics(df, "label", ["a", "b"])).first()["model"] == "b"
    # ties: the earlier run wins
    assert best_model(model_metrics(df, "label", ["b", "label"])).first()["model"] == "b"
