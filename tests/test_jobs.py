import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.plans import jobs


@pytest.fixture
def census_csv(tmp_path):
    rng = np.random.default_rng(0)
    lines = ["age, workclass, fnlwgt, education, education-num, occupation, sex, capital-gain, capital-loss, "
             "hours-per-week, native-country, salary"]
    for i in range(400):
        age = int(rng.integers(18, 70))
        edu = int(rng.integers(1, 17))
        hours = int(rng.integers(10, 70))
        wc = rng.choice(["Private", "Self-emp", "State-gov", "?"])
        occ = rng.choice(["Sales", "Tech-support", "Exec-managerial", "?"])
        sex = rng.choice(["Male", "Female"])
        gain = int(rng.choice([0, 0, 0, 5000]))
        high = (edu > 11 and hours > 40) or gain > 0
        lines.append(f"{age}, {wc}, {int(rng.integers(10000, 300000))}, Bachelors, {edu}, {occ}, {sex}, {gain}, 0, "
                     f"{hours}, {rng.choice(['United-States', 'Mexico', '?'])}, {'>50K' if high else '<=50K'}")
    lines += lines[1:4]  # exact duplicates
    path = tmp_path / "salary.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_clean_build_explore_train_score(spark, census_csv, tmp_path):
    interim = str(tmp_path / "interim")
    cleaned = jobs.clean(spark, census_csv, interim)
    assert "fnlwgt" not in cleaned.columns and "education" not in cleaned.columns
    assert cleaned.where(F.col("workclass").isNull() | F.col("occupation").isNull()).count() == 0
    assert cleaned.count() == cleaned.distinct().count()

    table_path = str(tmp_path / "table")
    table = jobs.build_table(spark, interim, table_path)
    n = table.count()
    n_test = table.where("split = 'test'").count()
    assert n_test == -(-n * 2 // 10)
    assert dict(table.dtypes)["salary"] == "int"
    assert not [c for c, t in table.dtypes if t == "string" and c != "split"]

    report = jobs.explore(spark, census_csv, str(tmp_path / "report"))
    assert {"summary", "missing", "numeric_stats", "outliers", "class_balance", "correlation"} <= set(report)
    assert spark.read.parquet(report["missing"]).count() == 3

    result = jobs.train(spark, table_path, str(tmp_path / "out"), models="xgboost,mlp", tune=True,
                        params={"xgboost": {"n_estimators": 4, "max_depth": 2},
                                "mlp": {"hidden_layer_sizes": (16,), "max_iter": 4, "learning_rate_init": 0.01}},
                        searches={"xgboost": {"grid": {"n_estimators": [2, 3], "max_depth": [1, 2]}, "n_iter": 2},
                                  "mlp": {"grid": {"hidden_layer_sizes": [(8,), (16, 8)]}, "search": {"max_iter": 3}, "refit": {"max_iter": 3}}})
    assert result["best"] in result["models"]
    assert 0.0 <= result["metrics"][result["best"]]["f1"] <= 1.0
    runs = spark.read.parquet(str(tmp_path / "out" / "runs" / "metrics"))
    assert runs.select("run_id").distinct().count() == 4

    pred = jobs.score(spark, result["best_path"], table_path, str(tmp_path / "pred"), key=["age", "hours-per-week"])
    assert pred.count() == n and set(pred.columns) >= {"prediction", "p1"}


def test_model_registry_unknown_key():
    from tabsmith.plans.models import select_models

    assert select_models("mlp, xgboost") == ["mlp", "xgboost"]
    with pytest.raises(KeyError):
        select_models("mlp,forest")


def test_gbt_learns_separable_and_reloads(spark, tmp_path):
    from tabsmith.plans.models import build_pipeline, predict
    from tabsmith.sources.sinks import load_model, save_model

    rows = [(float(i), float(i % 7), int(i >= 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, z double, label int")
    model = build_pipeline("gbt", ["x", "z"], ["x"], "label", n_estimators=5, max_depth=2).fit(df)
    pred = predict(model, df, keep=["label"])
    assert pred.where("label = prediction").count() == 100
    save_model(model, str(tmp_path / "m"))
    again = predict(load_model(str(tmp_path / "m")), df, keep=["label"])
    assert again.collect() == pred.collect()


def test_grid_sampling_is_seeded_and_distinct():
    from tabsmith.plans.tuning import GBT_GRID, sample_grid, sample_grid_size

    assert sample_grid_size(GBT_GRID) == 972
    a, b = sample_grid(GBT_GRID, 8, 42), sample_grid(GBT_GRID, 8, 42)
    assert a == b and len({tuple(sorted(x.items())) for x in a}) == 8


def test_streaming_applies_fitted_stages(spark, tmp_path):
    from tabsmith.operators.encoding import BinaryTargetEncoder, OneHotCategoricalEncoder
    from tabsmith.streaming.prepared import apply_fitted

    src = tmp_path / "in"
    batch = spark.createDataFrame([("a", ">50K", 1), ("b", "<=50K", 2), ("a", "<=50K", 3)],
                                  "cat string, salary string, k long")
    batch.write.parquet(str(src))
    ohe = OneHotCategoricalEncoder(exclude=["salary"], dropFirst=False).fit(batch)
    stream = spark.readStream.schema(batch.schema).parquet(str(src))
    out = apply_fitted(stream, [BinaryTargetEncoder(column="salary", positiveLabel=">50K"), ohe])
    q = out.writeStream.format("memory").queryName("prepared").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    rows = sorted(tuple(r) for r in spark.sql("select k, salary, cat_a, cat_b from prepared").collect())
    assert rows == [(1, 1, 1, 0), (2, 0, 0, 1), (3, 0, 1, 0)]


def test_gbt_early_stopping_with_holdout_column(spark):
    from tabsmith.operators.split import holdout
    from tabsmith.plans.models import build_pipeline

    rows = [(float(i), int(i % 10 >= 5)) for i in range(200)]
    df = holdout(spark.createDataFrame(rows, "x double, label int"), 0.2, 3, ["x"], "is_val")
    model = build_pipeline("gbt", ["x"], ["x"], "label", n_estimators=50, max_depth=2,
                           validation_col="is_val").fit(df)
    gbt = model.stages[-1]
    assert gbt.getNumTrees <= 50 and gbt.getOrDefault("validationIndicatorCol") == "is_val"


def test_train_with_validation_share_stops_boosting_early(spark, tmp_path):
    from tabsmith.sources.sinks import load_model

    # the label is noise: the validation loss stops falling within a few rounds
    rows = [(i, float(i * 7919 % 101), i * 104729 % 13 % 2, "test" if i % 5 == 0 else "train") for i in range(400)]
    path = str(tmp_path / "table")
    spark.createDataFrame(rows, "k long, x double, label int, split string").write.parquet(path)
    out = jobs.train(spark, path, str(tmp_path / "out"), label="label", models="gbt", tune=False, scale_cols=["x"],
                     key=["k"], params={"gbt": {"n_estimators": 12, "max_depth": 4}}, validation_share=0.25)
    trees = load_model(out["best_path"]).stages[-1]
    assert trees.numFeatures == 1 and trees.getNumTrees < 12
