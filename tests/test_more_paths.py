import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabsmith.operators.encoding import OneHotCategoricalEncoder, vector_one_hot
from tabsmith.session import cut_lineage, ensure_checkpoint_dir
from tabsmith.sources.loaders import CSVDataLoader, with_load_counts
from tabsmith.sources.sinks import export_four_files


def test_csv_with_explicit_schema(spark, sample_csv):
    df = CSVDataLoader(sample_csv, schema="lot int, roast string, grade string, extra double").load(spark)
    assert df.dtypes == [("lot", "int"), ("roast", "string"), ("grade", "string"), ("extra", "double")]
    assert df.where("roast is null").count() == 1 and df.where("extra is null").count() == 4


def test_load_counts_observed_without_extra_job(spark, sample_csv):
    df, obs = with_load_counts(CSVDataLoader(sample_csv).load(spark))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 4


def test_vector_one_hot_equals_dummy_columns(spark):
    rows = [("b", "x"), ("a", None), ("c", "y"), ("a", "x"), (None, "z")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, s string, t string")
    dummies = OneHotCategoricalEncoder(dropFirst=True).fit(df).transform(df).orderBy("k")
    vec = Pipeline(stages=vector_one_hot(["s", "t"], True)).fit(df).transform(df).orderBy("k")
    left = np.array([[r[c] for c in dummies.columns if c != "k"] for r in dummies.collect()], dtype=float)
    right = np.array([r["a"] for r in vec.select(vector_to_array("onehot").alias("a")).collect()])
    assert left.shape == right.shape and np.array_equal(left, right)


def test_four_file_export_lines_up(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i) * 2, i % 2, "train" if i < 8 else "test") for i in range(10)],
                               "id long, f double, label int, split string")
    paths = export_four_files(df, str(tmp_path), "label", ["id"])
    feats = spark.read.option("header", True).csv(paths["features"]).collect()
    labels = spark.read.option("header", True).csv(paths["labels"]).collect()
    assert [r["id"] for r in feats] == [r["id"] for r in labels] and len(feats) == 8
    assert spark.read.option("header", True).csv(paths["test_labels"]).count() == 2


def test_checkpoint_dir_from_session_and_cut_lineage(spark):
    d = ensure_checkpoint_dir(spark)
    assert d
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    assert cut_lineage(df).agg(F.sum("y")).first()[0] == 90


def test_score_stream_with_pipeline(spark, tmp_path):
    from tabsmith.plans.models import build_pipeline
    from tabsmith.streaming.prepared import score_stream

    train = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "x double, label int")
    model = build_pipeline("gbt", ["x"], ["x"], "label", n_estimators=3, max_depth=2).fit(train)
    src = tmp_path / "in"
    train.select("x", F.col("label").alias("k")).write.parquet(str(src))
    stream = spark.readStream.schema("x double, k int").parquet(str(src))
    q = score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "ck"), key=["k", "x"], trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 20 and out.where("prediction = k").count() == 20
