"""

``entry(spark)`` runs the flagship profile (A7-A9 numeric summary of ``lineitem``) on
section 2), each reading whole driver tables through the library; ``oracle_sql()``
holds the same computation in DuckDB SQL where SQL can express it.

Floating results are rounded with ``round(x * 10^d) / 10^d`` in BOTH engines: the two
engines sum in different orders, so the last bits differ; this form rounds the same
double the same way in Spark and DuckDB.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.columns import col
from tabsmith.operators import chartdata, correlation, evaluate, profile, quality
from tabsmith.operators.cleaning import CleaningPipeline, DropColumns, DropDuplicateRows, ModeImputer
from tabsmith.operators.encoding import BinaryTargetEncoder, OneHotCategoricalEncoder, vector_one_hot
from tabsmith.operators.scaling import StandardNumericalScaler
from tabsmith.operators.split import assign_folds, assign_split, holdout
from tabsmith.sources.loaders import apply_null_tokens

SMOKE_DIR = "/root/testdata/sf0.001"
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
PRIORITY_TOKEN = "4-NOT SPECIFIED"
SEED = 42


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _r(c, digits: int = 6):
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def _round_cols(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[_r(col(c), digits).alias(c) if c in names else col(c) for c in df.columns])


def _orders_tokens(spark, sf_dir) -> DataFrame:
    return apply_null_tokens(_t(spark, sf_dir, "orders").drop("o_orderdate"), [PRIORITY_TOKEN])


# ----------------------------------------------------------------- queries

def q_a7_summary(spark, sf_dir):
    out = profile.numerical_summary(_t(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC)
    out = _round_cols(out.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"),
                      ["min", "q25", "q50", "q75", "max"], 6)
    # means of 2-decimal data over 60,000 rows end exactly on a 5 at the 7th decimal
    return _round_cols(out, ["mean", "std"], 8)


def q_a8_skew(spark, sf_dir):
    out = profile.numerical_summary(_t(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC, quantiles=False)
    return _round_cols(out.select("column", "skew"), ["skew"], 9)


def q_a9_kurt(spark, sf_dir):
    out = profile.numerical_summary(_t(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC, quantiles=False)
    return _round_cols(out.select("column", "kurtosis"), ["kurtosis"], 9)


def q_s3_null_tokens(spark, sf_dir):
    return _orders_tokens(spark, sf_dir)


def q_s6_infer_types(spark, sf_dir):
    from tabsmith.sources.loaders import infer_types

    rows = []
    for name in ("orders", "events"):
        table = _t(spark, sf_dir, name)
        text = table.select(*[col(c).cast("string").alias(c) for c in table.columns])  # as a text reader sees it
        rows += [(name, f.name, f.dataType.simpleString()) for f in infer_types(text).schema.fields]
    return spark.createDataFrame(rows, "table_name string, column string, inferred string")


def q_a1_missing(spark, sf_dir):
    return _round_cols(quality.missing_values_report(_orders_tokens(spark, sf_dir)), ["missing_pct"], 6)


def q_c2_mode_impute(spark, sf_dir):
    out = ModeImputer(["o_orderpriority"])(_orders_tokens(spark, sf_dir))
    return out.select("o_orderkey", "o_orderpriority")


def _repeated_lineitem(spark, sf_dir) -> DataFrame:
    """Whole lineitem, and the rows of every seventh order once more."""
    li = _t(spark, sf_dir, "lineitem").drop("l_shipdate")
    return li.unionByName(li.where("l_orderkey % 7 = 0"))


def q_c5_dedup_by_digest(spark, sf_dir):
    from tabsmith.operators.duplicates import distinct_rows

    return distinct_rows(_repeated_lineitem(spark, sf_dir))


def q_a2_dup_count_by_digest(spark, sf_dir):
    from tabsmith.operators.duplicates import surplus_rows

    return surplus_rows(_repeated_lineitem(spark, sf_dir))


def q_c5_dedup_events(spark, sf_dir):
    return DropDuplicateRows()(_t(spark, sf_dir, "events").select("event_type", "user_id"))


def q_c5_dedup_lineitem(spark, sf_dir):
    cols = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    return DropDuplicateRows()(_t(spark, sf_dir, "lineitem").select(*cols))


def q_a2_dup_count_events(spark, sf_dir):
    return quality.duplicate_rows(_t(spark, sf_dir, "events").select("event_type", "user_id"))


def q_a2_dup_count_lineitem(spark, sf_dir):
    cols = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    return quality.duplicate_rows(_t(spark, sf_dir, "lineitem").select(*cols))


def q_a3_cardinality(spark, sf_dir):
    return quality.cardinality_report(_t(spark, sf_dir, "part"))


def q_a4_constant(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn("l_source", F.lit("tpch"))
    return quality.constant_report(li)


def q_a5_summary(spark, sf_dir):
    out = quality.summary(_orders_tokens(spark, sf_dir))
    return out.select("n_rows", "n_columns", "n_duplicate_rows",
                      F.array_join("columns_with_missing", ",").alias("columns_with_missing"),
                      F.array_join("constant_columns", ",").alias("constant_columns"))


def q_a10_top_n(spark, sf_dir):
    return profile.categorical_summary(_t(spark, sf_dir, "part"), 5, ["p_brand", "p_type"])


def q_v4_category_freq(spark, sf_dir):
    return chartdata.category_frequency(_t(spark, sf_dir, "part"), ["p_brand", "p_type"])


def q_a11_outliers(spark, sf_dir):
    return profile.outliers_iqr(_t(spark, sf_dir, "events"), "value", keep=["event_id", "value"])


def q_a12_outlier_summary(spark, sf_dir):
    out = profile.outlier_summary(_t(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC)
    return _round_cols(out, ["pct_outliers"], 6)


def q_a13_pearson(spark, sf_dir):
    return _round_cols(correlation.pearson_matrix(_t(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC), ["corr"], 9)


def q_a14_spearman(spark, sf_dir):
    return _round_cols(correlation.spearman_matrix(_t(spark, sf_dir, "lineitem"), LINEITEM_MEASURES),
                       ["corr"], 9)


def q_a15_kendall(spark, sf_dir):
    cols = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
    return _round_cols(correlation.kendall_matrix(_t(spark, sf_dir, "lineitem"), cols), ["corr"], 9)


def q_v5_heatmap(spark, sf_dir):
    return _round_cols(correlation.heatmap_cells(_t(spark, sf_dir, "lineitem"), "pearson", LINEITEM_MEASURES),
                       ["corr"], 9)


def q_a16_distribution(spark, sf_dir):
    return _round_cols(profile.class_distribution(_t(spark, sf_dir, "labels"), "quality"), ["share"], 9)


def q_v6_balance(spark, sf_dir):
    return _round_cols(chartdata.class_balance(_t(spark, sf_dir, "labels"), "toxic"), ["share"], 9)


def q_v1_histogram(spark, sf_dir):
    out = chartdata.histogram(_t(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"])
    return _round_cols(out, ["lo", "hi"], 6)


def q_v2_density(spark, sf_dir):
    out = chartdata.density_curve(_t(spark, sf_dir, "lineitem"), ["l_extendedprice"])
    return _round_cols(out, ["x"], 6).withColumn("density", _r(F.col("density") * F.lit(1e6), 6))


def q_v3_box_stats(spark, sf_dir):
    out = chartdata.box_stats(_t(spark, sf_dir, "lineitem"), "l_returnflag", ["l_extendedprice", "l_quantity"])
    return _round_cols(out, ["q1", "median", "q3", "whislo", "whishi"], 6)


def q_f1_target(spark, sf_dir):
    enc = BinaryTargetEncoder(column="o_orderstatus", positiveLabel="F", outputColumn="label")
    return enc.transform(_t(spark, sf_dir, "orders")).select("o_orderkey", "label")


def q_f2_one_hot(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").drop("o_orderdate")
    model = OneHotCategoricalEncoder(dropFirst=True).fit(orders)
    return model.transform(orders)


def q_f3_vector_one_hot(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    orders = _t(spark, sf_dir, "orders").drop("o_orderdate")
    model = Pipeline(stages=vector_one_hot(["o_orderstatus", "o_orderpriority"], True)).fit(orders)
    slots = F.transform(vector_to_array("onehot"), lambda x: x.cast("int").cast("string"))
    return model.transform(orders).select("o_orderkey", F.array_join(slots, ",").alias("onehot"))


def q_f6_scale(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, *LINEITEM_MEASURES)
    out = StandardNumericalScaler(columns=LINEITEM_MEASURES).fit(li).transform(li)
    return _round_cols(out, LINEITEM_MEASURES, 6)


def q_f7_scale_holdout(spark, sf_dir):
    """fit on the train split, transform the test split with the train statistics."""
    li = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, "l_returnflag", *LINEITEM_MEASURES)
    marked = assign_split(li, 0.2, SEED, "l_returnflag", LINEITEM_KEY)
    model = StandardNumericalScaler(columns=LINEITEM_MEASURES).fit(marked.where("split = 'train'"))
    out = model.transform(marked.where("split = 'test'")).select(*LINEITEM_KEY, *LINEITEM_MEASURES)
    return _round_cols(out, LINEITEM_MEASURES, 6)


def q_f8_split(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = assign_split(li, 0.2, SEED, "l_returnflag", LINEITEM_KEY)
    return out.select(*LINEITEM_KEY, "l_returnflag", "split")


def q_s10_split_sink(spark, sf_dir):
    """The split table written once, partitioned by ``split``, label inside; the
    read-back of the test side prunes the train partition (PartitionFilters)."""
    import uuid

    from tabsmith.session import shared_path
    from tabsmith.sources.sinks import write_split_table

    li = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, "l_returnflag", *LINEITEM_MEASURES)
    path = shared_path(spark, f"s10-split-{uuid.uuid4().hex}")
    write_split_table(assign_split(li, 0.2, SEED, "l_returnflag", LINEITEM_KEY), path)
    return spark.read.parquet(path).where(F.col("split") == "test").select(*LINEITEM_KEY, "l_returnflag")


def q_f9_split_plain(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return assign_split(li, 0.2, SEED, None, LINEITEM_KEY).select(*LINEITEM_KEY, "split")


def q_f11_holdout(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return holdout(li, 0.2, 7, LINEITEM_KEY).select(*LINEITEM_KEY, "is_validation")


def q_f13_folds(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return assign_folds(li, 3, SEED, "l_returnflag", LINEITEM_KEY).select(*LINEITEM_KEY, "l_returnflag", "fold")


def q_f8_split_hot_key(spark, sf_dir):
    """The split key repeats in whole classes: every row of a class ties."""
    li = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, "l_returnflag", "l_quantity")
    return assign_split(li, 0.2, SEED, "l_returnflag", ["l_returnflag"])


def q_f13_folds_repeated_key(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, "l_returnflag", "l_quantity")
    return assign_folds(li, 3, SEED, "l_returnflag", ["l_suppkey"])


def q_j1_pair_by_key(spark, sf_dir):
    from tabsmith.operators.pairing import pair_by_key

    orders = _t(spark, sf_dir, "orders")
    return pair_by_key(orders.select("o_orderkey", "o_totalprice"), orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


def q_c4_fill_constant(spark, sf_dir):
    """C4 on whole ``events`` with NaN put in for every seventh id."""
    from tabsmith.operators.cleaning import fill_constant

    events = _t(spark, sf_dir, "events").select("event_id", F.expr("CASE WHEN event_id % 7 = 0 THEN double('NaN') ELSE value END").alias("value"))
    return fill_constant(events, "value", -1.0)


def _labels_pred(spark, sf_dir):
    return _t(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def q_e1_e4_metrics(spark, sf_dir):
    out = evaluate.binary_metrics(_labels_pred(spark, sf_dir))
    return _round_cols(out, ["accuracy", "precision", "recall", "f1"], 9)


def q_e6_confusion(spark, sf_dir):
    return evaluate.confusion_cells(_labels_pred(spark, sf_dir))


def q_e5_report(spark, sf_dir):
    return _round_cols(evaluate.classification_report(_labels_pred(spark, sf_dir)),
                       ["precision", "recall", "f1"], 9)


def q_w1_clean(spark, sf_dir):
    pipeline = CleaningPipeline([DropColumns(["o_orderdate", "o_comment"]), ModeImputer(["o_orderpriority"]),
                                 DropDuplicateRows()])
    raw = apply_null_tokens(_t(spark, sf_dir, "orders"), [PRIORITY_TOKEN])
    return pipeline.run(raw)


def q_w2_build_table(spark, sf_dir):
    from tabsmith.plans.table import TableBuilder

    raw = apply_null_tokens(_t(spark, sf_dir, "orders"), [PRIORITY_TOKEN])
    builder = TableBuilder(
        cleaning=CleaningPipeline([DropColumns(["o_orderdate"]), ModeImputer(["o_orderpriority"]),
                                   DropDuplicateRows()]),
        target="o_orderstatus", positive_label="F", label="label", key=["o_orderkey"],
        exclude_from_encoding=[], test_size=0.2, seed=SEED)
    return builder.build(raw)


def _scored_holdout(spark, sf_dir, name, **params) -> DataFrame:
    """A model (the default one but for ``params``), trained on the train split of lineitem, scores
    the test split; what it may decide for itself (the probability) is only checked."""
    from tabsmith.plans.models import score_holdout

    out = score_holdout(_t(spark, sf_dir, "lineitem"), name, **params)
    return out.select(*LINEITEM_KEY, "label", F.col("p1").between(0, 1).alias("p_in_range"),
                      (F.col("prediction") == (F.col("p1") >= 0.5).cast("int")).alias("threshold_holds"))


def q_m2_gbt_score(spark, sf_dir):
    return _scored_holdout(spark, sf_dir, "gbt")


def q_m2_xgboost_score(spark, sf_dir):
    return _scored_holdout(spark, sf_dir, "xgboost", n_estimators=30)


def q_m3_mlp_score(spark, sf_dir):
    return _scored_holdout(spark, sf_dir, "mlp")


# Rule "models" predicting l_returnflag = 'R' on lineitem: inputs for comparing models
# (E7, V7, O4) without training. The last one never predicts the positive class
# (zero-division path).
def _rule_models():
    return [
        ("discount_ge_005", F.col("l_discount") >= 0.05),
        ("quantity_gt_25", F.col("l_quantity") > 25),
        ("tax_lt_004", F.col("l_tax") < 0.04),
        ("never_positive", F.lit(False)),
    ]


def _rule_scored(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                     *[e.cast("int").alias(n) for n, e in _rule_models()])


def _rule_metrics(spark, sf_dir) -> DataFrame:
    return evaluate.model_metrics(_rule_scored(spark, sf_dir), "label", [n for n, _ in _rule_models()])


def q_e7_compare(spark, sf_dir):
    return _round_cols(_rule_metrics(spark, sf_dir), ["accuracy", "precision", "recall", "f1"], 9)


def q_v7_confusion_models(spark, sf_dir):
    return evaluate.model_confusion(_rule_scored(spark, sf_dir), "label", [n for n, _ in _rule_models()])


def q_o4_best_model(spark, sf_dir):
    best = evaluate.best_model(_rule_metrics(spark, sf_dir))
    return _round_cols(best.select("run_order", "model", "f1"), ["f1"], 9)


def q_c3_mode(spark, sf_dir):
    from tabsmith.operators.cleaning import mode_table

    return mode_table(_t(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size", "p_name"])


def q_a17_missing_one(spark, sf_dir):
    out = quality.missing_count(_orders_tokens(spark, sf_dir), "o_orderpriority")
    return _round_cols(out, ["missing_pct"], 6)


def q_s5_strip(spark, sf_dir):
    from tabsmith.sources.loaders import strip_string_values

    return strip_string_values(_t(spark, sf_dir, "documents"))


def q_s2_csv_scan(spark, sf_dir):
    """S2-S6 end to end: Spark writes ``orders`` as CSV text into the shared folder, the
    CSV loader reads it back (header, null tokens, strip, one-pass type inference)."""
    import uuid

    from tabsmith.session import shared_path
    from tabsmith.sources.loaders import CSVDataLoader

    path = shared_path(spark, f"s2-orders-csv-{uuid.uuid4().hex}")
    _t(spark, sf_dir, "orders").drop("o_orderdate").write.option("header", True).csv(path)
    return CSVDataLoader(path, null_tokens=[PRIORITY_TOKEN]).load(spark)


def _search_rows(found: DataFrame) -> DataFrame:
    """Candidates of a search, their parameters as sorted text, and whether the score is one."""
    text = F.array_join(F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"]))), " ")
    return found.select("candidate", text.alias("params"), F.col("f1").between(0, 1).alias("f1_in_range"))


def q_m7_tune_gbt(spark, sf_dir):
    """M7, M9: three folds of two candidates, grown in the same passes."""
    from tabsmith.plans.tuning import tune_holdout

    grid = {"n_estimators": [5], "max_depth": [2, 3]}
    return _search_rows(tune_holdout(_t(spark, sf_dir, "lineitem"), "xgboost", grid=grid, n_iter=2))


def q_m8_tune_mlp(spark, sf_dir):
    """M8, M9: two small networks trained in the same epochs, until they stop early."""
    from tabsmith.plans.tuning import tune_holdout

    grid = {"hidden_layer_sizes": [(8,), (16, 8)], "learning_rate_init": [0.01], "batch_size": [64]}
    return _search_rows(tune_holdout(_t(spark, sf_dir, "lineitem"), "mlp", grid=grid, max_candidates=2))


def q_v3_box_stats_by_order(spark, sf_dir):
    """V3 with as many classes as orders: quartiles stay a table on the executors."""
    out = chartdata.box_stats(_t(spark, sf_dir, "lineitem"), "l_orderkey", ["l_extendedprice", "l_quantity"])
    return _round_cols(out, ["q1", "median", "q3", "whislo", "whishi"], 6)


def q_a14_spearman_missing(spark, sf_dir):
    """A14 with missing values: every pair ranks its own complete rows."""
    li = _t(spark, sf_dir, "lineitem").select(
        F.expr("CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity"), "l_extendedprice",
        F.expr("nullif(l_discount, 0.05D) AS l_discount"), F.expr("nullif(l_tax, 0.02D) AS l_tax"))
    return _round_cols(correlation.spearman_matrix(li, LINEITEM_MEASURES), ["corr"], 9)


def q_w4_train(spark, sf_dir):
    """The training job on the lineitem table with small
    explicit models: baselines that stop early, searches, the run log, the saved best."""
    from tabsmith.plans.jobs import train
    from tabsmith.plans.runs import RunLog
    from tabsmith.sources.sinks import write_split_table

    base = _scratch(spark, "w4-train")
    data = _t(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, *LINEITEM_MEASURES, (F.col("l_returnflag") == "R").cast("int").alias("label"))
    write_split_table(assign_split(data, 0.2, SEED, "label", LINEITEM_KEY), f"{base}/table")
    small = {"hidden_layer_sizes": (8,), "learning_rate_init": 0.02, "batch_size": 256}
    done = train(spark, f"{base}/table", f"{base}/out", label="label", scale_cols=LINEITEM_MEASURES, key=LINEITEM_KEY, validation_share=0.2,
                 params={"xgboost": {"n_estimators": 6, "max_depth": 2}, "mlp": {**small, "max_iter": 6}},
                 searches={"xgboost": {"grid": {"n_estimators": [4], "max_depth": [1, 2]}, "n_iter": 2},
                           "mlp": {"grid": {k: [v] for k, v in small.items()}, "search": {"max_iter": 4}, "refit": {"max_iter": 4}}})
    log = RunLog(spark, f"{base}/out/runs")
    best = max(done["metrics"], key=lambda n: done["metrics"][n]["f1"])
    rows = log.runs().join(log.metrics(), "run_id")
    return rows.select("run_name", "model_key", "version", "name", F.col("value").between(0, 1).alias("in_range"),
                       F.lit(done["best"] == best).alias("best_has_greatest_f1"))


def q_x5_rounded_report(spark, sf_dir):
    """A report written with rounded numbers; operators return full precision."""
    from tabsmith.sources.sinks import write_report

    li = _t(spark, sf_dir, "lineitem")
    paths = write_report({"stats": profile.numerical_summary(li, ["l_quantity", "l_linenumber"]).select("column", "count", "mean", "std")},
                         _scratch(spark, "x5-report"), digits=2)
    return spark.read.parquet(paths["stats"])


def q_s7_missing_path(spark, sf_dir):
    """Which of the tables' paths, and of paths beside them, the loader finds."""
    from tabsmith.sources.loaders import ParquetLoader

    rows = []
    for name in ("orders", "lineitem", "part"):
        for path in (os.path.join(sf_dir, f"{name}.parquet"), os.path.join(sf_dir, f"{name}.absent")):
            try:
                rows.append((name, path.rsplit(".", 1)[1], ParquetLoader(path).load(spark).count()))
            except FileNotFoundError:
                rows.append((name, path.rsplit(".", 1)[1], None))
    return spark.createDataFrame(rows, "table_name string, suffix string, n_rows long")


def q_s2_csv_split(spark, sf_dir):
    """Files of quoted ``documents`` texts with line breaks, each read by several tasks."""
    from tabsmith.sources.loaders import CSVDataLoader

    path = _scratch(spark, "s2-documents-csv")
    _t(spark, sf_dir, "documents").select("doc_id", "text", "lang").write.option("header", True).option("escape", '"').csv(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = CSVDataLoader(path, null_tokens=[], default_null_tokens=False, schema="doc_id long, text string, lang string").load(spark)
        out = _scratch(spark, "s2-documents-split")
        df.write.parquet(out)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    return spark.read.parquet(out)


def _scratch(spark, name: str) -> str:
    """A new folder in the shared scratch folder."""
    import uuid

    from tabsmith.session import shared_path

    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_a7_special_values(spark, sf_dir):
    """A7 on whole ``events`` with infinities put in for two of every fifty ids."""
    events = _t(spark, sf_dir, "events").select(F.expr(
        "CASE event_id % 50 WHEN 0 THEN double('Infinity') WHEN 1 THEN double('-Infinity') ELSE value END").alias("value"))
    out = profile.numerical_summary(events, ["value"]).select("column", "count", "min", "q25", "q50", "q75", "max")
    return _round_cols(out, ["q25", "q50", "q75"], 6)


def q_p2_column_roles(spark, sf_dir):
    """The numeric and the categorical columns of three tables."""
    from tabsmith.functions.columns import categorical_columns, numeric_columns

    rows = []
    for name in ("lineitem", "orders", "part"):
        table = _t(spark, sf_dir, name)
        rows += [(name, c, "numeric") for c in numeric_columns(table)]
        rows += [(name, c, "categorical") for c in categorical_columns(table)]
    return spark.createDataFrame(rows, "table_name string, column string, role string")


def q_s4_header_strip(spark, sf_dir):
    from tabsmith.sources.loaders import strip_header

    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return strip_header(part.toDF(*[f"  {c}\t" for c in part.columns]))


def q_s8_load_counts(spark, sf_dir):
    """Rows counted by the scan of each table's next action."""
    from tabsmith.sources.loaders import with_load_counts

    rows = []
    for name in ("orders", "lineitem", "documents"):
        df, seen = with_load_counts(_t(spark, sf_dir, name), f"load_{name}")
        df.write.format("noop").mode("overwrite").save()
        rows.append((name, seen.get["rows"]))
    return spark.createDataFrame(rows, "table_name string, n_rows long")


def q_s9_table_sink(spark, sf_dir):
    from tabsmith.sources.sinks import write_table

    path = _scratch(spark, "s9-table")
    write_table(_t(spark, sf_dir, "orders").drop("o_orderdate"), path)
    return spark.read.parquet(path)


def q_s12_predictions(spark, sf_dir):
    """Keyed predictions of a rule, written and read back."""
    from tabsmith.sources.sinks import write_predictions

    path = _scratch(spark, "s12-predictions")
    scored = _t(spark, sf_dir, "lineitem").withColumn("prediction", (F.col("l_quantity") > 25).cast("int"))
    write_predictions(scored, path, LINEITEM_KEY)
    return spark.read.parquet(path)


def q_s14_run_log(spark, sf_dir):
    """The metrics of the compared rules (E7), logged and read back by run."""
    from tabsmith.plans.runs import RunLog

    log = RunLog(spark, _scratch(spark, "s14-runs"))
    for m in _rule_metrics(spark, sf_dir).collect():          # one row a model
        log.log_run(m["model"], "rule", "baseline", {}, {k: m[k] for k in ("accuracy", "precision", "recall", "f1")})
    out = log.runs().join(log.metrics(), "run_id").select("run_name", "version", "name", "value")
    return _round_cols(out, ["value"], 9)


def q_s15_report_sink(spark, sf_dir):
    """Two report tables written and read back."""
    from tabsmith.sources.sinks import write_report

    part = _t(spark, sf_dir, "part")
    paths = write_report({"cardinality": quality.cardinality_report(part),
                          "levels": chartdata.category_frequency(part, ["p_brand", "p_type"])}, _scratch(spark, "s15-report"))
    cardinality = spark.read.parquet(paths["cardinality"]).select(
        F.lit("cardinality").alias("section"), "column", F.lit(None).cast("string").alias("value"),
        F.col("unique_values").alias("cnt"))
    return cardinality.unionByName(spark.read.parquet(paths["levels"]).select(
        F.lit("levels").alias("section"), "column", "value", "cnt"))


def q_w3_explore(spark, sf_dir):
    """The explore job on ``orders``; levels, classes and counts of its report tables."""
    from tabsmith.plans.jobs import explore

    paths = explore(spark, os.path.join(sf_dir, "orders.parquet"), _scratch(spark, "w3-explore"), target="o_orderstatus")
    none = F.lit(None).cast("string")
    parts = [
        spark.read.parquet(paths["category_counts"]).select(F.lit("level").alias("section"), "column", "value", "cnt"),
        spark.read.parquet(paths["class_balance"]).select(F.lit("class").alias("section"),
                                                          F.lit("o_orderstatus").alias("column"), "value", "cnt"),
        spark.read.parquet(paths["numeric_stats"]).select(F.lit("numeric").alias("section"), "column",
                                                          none.alias("value"), F.col("count").alias("cnt")),
        spark.read.parquet(paths["histograms"]).groupBy("column").agg(F.sum("cnt").alias("cnt")).select(
            F.lit("histogram").alias("section"), "column", none.alias("value"), "cnt"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_w5_score_bundle(spark, sf_dir):
    """A small boosted model trained on the train split of lineitem is
    saved, loaded and applied to the test split by the scoring job; every row tells whether the
    probability, the threshold and the unsaved model agree with what the job wrote."""
    from tabsmith.plans.jobs import score
    from tabsmith.plans.models import build_pipeline, predict
    from tabsmith.sources.sinks import save_model, write_split_table

    base = _scratch(spark, "w5-score")
    data = _t(spark, sf_dir, "lineitem").select(
        *LINEITEM_KEY, *LINEITEM_MEASURES, "l_returnflag", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    write_split_table(assign_split(data, 0.2, SEED, "l_returnflag", LINEITEM_KEY), f"{base}/table")
    table = spark.read.parquet(f"{base}/table")
    model = build_pipeline("gbt", LINEITEM_MEASURES, LINEITEM_MEASURES, "label", n_estimators=3, max_depth=2) \
        .fit(table.where("split = 'train'"))
    save_model(model, f"{base}/model")
    test = f"{base}/table/split=test"
    loaded = score(spark, f"{base}/model", test, f"{base}/scored", LINEITEM_KEY, threshold=0.3)
    direct = predict(model, spark.read.parquet(test), 0.3, keep=LINEITEM_KEY) \
        .withColumnsRenamed({"p1": "p1_direct", "prediction": "direct"})
    return loaded.join(direct, LINEITEM_KEY).select(
        *LINEITEM_KEY, F.col("p1").between(0, 1).alias("p_in_range"),
        (F.col("prediction") == (F.col("p1") >= 0.3).cast("int")).alias("threshold_holds"),
        ((F.col("p1") == F.col("p1_direct")) & (F.col("prediction") == F.col("direct"))).alias("same_as_unsaved"))


def q_c6_removed_rows(spark, sf_dir):
    """Rows removed by de-duplication, observed during its action."""
    step = DropDuplicateRows(observe=True)
    step(_t(spark, sf_dir, "events").select("event_type", "user_id")).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(step.removed,)], "removed long")


def q_f5_unseen_levels(spark, sf_dir):
    """levels learned without the urgent orders, which then get zeros."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = OneHotCategoricalEncoder(dropFirst=True).fit(orders.where("o_orderpriority <> '1-URGENT'"))
    return model.transform(orders).select("o_orderkey", *[col(c) for c in model.encoded_columns_])


def q_s2_csv_quoted(spark, sf_dir):
    """Whole ``documents`` texts as quoted CSV with line breaks, written and read back."""
    from tabsmith.sources.loaders import CSVDataLoader

    path = _scratch(spark, "s2-documents-csv")
    _t(spark, sf_dir, "documents").select("doc_id", "text").write.option("header", True).option("escape", '"').csv(path)
    return CSVDataLoader(path, null_tokens=[], default_null_tokens=False, schema="doc_id long, text string").load(spark)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "a7_summary": q_a7_summary,
    "a8_skew": q_a8_skew,
    "a9_kurt": q_a9_kurt,
    "s3_null_tokens": q_s3_null_tokens,
    "s6_infer_types": q_s6_infer_types,
    "a1_missing": q_a1_missing,
    "c2_mode_impute": q_c2_mode_impute,
    "c5_dedup_events": q_c5_dedup_events,
    "c5_dedup_lineitem": q_c5_dedup_lineitem,
    "a2_dup_count_events": q_a2_dup_count_events,
    "a2_dup_count_lineitem": q_a2_dup_count_lineitem,
    "a3_cardinality": q_a3_cardinality,
    "a4_constant": q_a4_constant,
    "a5_summary": q_a5_summary,
    "a10_top_n": q_a10_top_n,
    "v4_category_freq": q_v4_category_freq,
    "a11_outliers": q_a11_outliers,
    "a12_outlier_summary": q_a12_outlier_summary,
    "a13_pearson": q_a13_pearson,
    "a14_spearman": q_a14_spearman,
    "a15_kendall": q_a15_kendall,
    "v5_heatmap": q_v5_heatmap,
    "a16_distribution": q_a16_distribution,
    "v6_balance": q_v6_balance,
    "v1_histogram": q_v1_histogram,
    "v2_density": q_v2_density,
    "v3_box_stats": q_v3_box_stats,
    "f1_target": q_f1_target,
    "f2_one_hot": q_f2_one_hot,
    "f3_vector_one_hot": q_f3_vector_one_hot,
    "f6_scale": q_f6_scale,
    "f8_split": q_f8_split,
    "f9_split_plain": q_f9_split_plain,
    "f11_holdout": q_f11_holdout,
    "f13_folds": q_f13_folds,
    "e1_e4_metrics": q_e1_e4_metrics,
    "e6_confusion": q_e6_confusion,
    "e5_report": q_e5_report,
    "w1_clean": q_w1_clean,
    "w2_build_table": q_w2_build_table,
    "m2_gbt_score": q_m2_gbt_score,
    "m2_xgboost_score_30_rounds": q_m2_xgboost_score,
    "m3_mlp_score": q_m3_mlp_score,
    "m7_tune_gbt_grid_of_2": q_m7_tune_gbt,
    "m8_tune_mlp_grid_of_2": q_m8_tune_mlp,
    "f7_scale_holdout": q_f7_scale_holdout,
    "s10_split_sink": q_s10_split_sink,
    "e7_compare": q_e7_compare,
    "v7_confusion_models": q_v7_confusion_models,
    "o4_best_model": q_o4_best_model,
    "c3_mode": q_c3_mode,
    "a17_missing_one": q_a17_missing_one,
    "s5_strip": q_s5_strip,
    "s2_csv_scan": q_s2_csv_scan,
    "f8_split_hot_key": q_f8_split_hot_key,
    "f13_folds_repeated_key": q_f13_folds_repeated_key,
    "j1_pair_by_key": q_j1_pair_by_key,
    "c4_fill_constant": q_c4_fill_constant,
    "a7_special_values": q_a7_special_values,
    "p2_column_roles": q_p2_column_roles,
    "s4_header_strip": q_s4_header_strip,
    "s8_load_counts": q_s8_load_counts,
    "s9_table_sink": q_s9_table_sink,
    "s12_predictions": q_s12_predictions,
    "s14_run_log": q_s14_run_log,
    "s15_report_sink": q_s15_report_sink,
    "w3_explore": q_w3_explore,
    "w5_score_bundle": q_w5_score_bundle,
    "c6_removed_rows": q_c6_removed_rows,
    "f5_unseen_levels": q_f5_unseen_levels,
    "s2_csv_quoted": q_s2_csv_quoted,
    "s2_csv_split": q_s2_csv_split,
    "v3_box_stats_by_order": q_v3_box_stats_by_order,
    "a14_spearman_missing": q_a14_spearman_missing,
    "w4_train": q_w4_train,
    "x5_rounded_report": q_x5_rounded_report,
    "s7_missing_path": q_s7_missing_path,
    "c5_dedup_by_digest": q_c5_dedup_by_digest,
    "a2_dup_count_by_digest": q_a2_dup_count_by_digest,
}


def _corpus() -> tuple[dict, dict]:
    """Queries and SQL of the corpus subpackage; none where it is not installed."""
    try:
        import corpus_pipeline
        from tabsmith.llm.queries import ORACLE, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tabsmith.llm", "tabsmith.llm.queries"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE, **sql}


def entry(spark: SparkSession) -> DataFrame:
    return profile.numerical_summary(_t(spark, SMOKE_DIR, "lineitem"), LINEITEM_NUMERIC)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_corpus()[0]}


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return {**ORACLE, **_corpus()[1]}
