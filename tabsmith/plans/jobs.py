"""User-level jobs (W1-W5). Each reads from and writes to (shared) storage.

Between jobs data travels as Parquet, so the second type inference of the reference's
CSV hand-over disappears, and a lost executor only recomputes its own tasks.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tabsmith.functions.columns import categorical_columns, numeric_columns
from tabsmith.operators import chartdata, correlation, profile, quality
from tabsmith.operators.cleaning import default_recipe
from tabsmith.operators.evaluate import Evaluator
from tabsmith.operators.split import holdout
from tabsmith.plans.models import build_pipeline, predict, select_models
from tabsmith.plans.runs import RunLog
from tabsmith.plans.table import TableBuilder
from tabsmith.sources.loaders import CENSUS_NULL_TOKENS, CSVDataLoader, DataLoader, ParquetLoader
from tabsmith.sources.sinks import load_model, save_model, write_predictions, write_report, write_split_table
from tabsmith.sources.sinks import write_table

# The reference's census configuration.
TARGET = "salary"
POSITIVE_LABEL = ">50K"
COLUMNS_TO_DROP = ["fnlwgt", "education"]
COLUMNS_TO_IMPUTE = ["workclass", "occupation", "native-country"]
VALIDATION = "is_validation"
STOPPING_ROUNDS = 10
NUMERICAL_COLUMNS = ["age", "education-num", "capital-gain", "capital-loss", "hours-per-week"]


def _loader(path: str, null_tokens=CENSUS_NULL_TOKENS) -> DataLoader:
    return CSVDataLoader(path, null_tokens) if path.lower().endswith(".csv") else ParquetLoader(path)


def clean(spark: SparkSession, in_path: str, out_path: str, drop=COLUMNS_TO_DROP, impute=COLUMNS_TO_IMPUTE,
          fmt: str = "parquet") -> DataFrame:
    """Scan -> drop -> impute -> dedup -> write."""
    df = default_recipe(drop, impute).run(_loader(in_path).load(spark))
    write_table(df, out_path, fmt)
    return spark.read.parquet(out_path) if fmt == "parquet" else df


def build_table(spark: SparkSession, in_path: str, out_path: str, target: str = TARGET,
                positive_label: str = POSITIVE_LABEL, key: list[str] | None = None, test_size: float = 0.2,
                seed: int = 42, drop_first: bool = True) -> DataFrame:
    """Cleaned table -> label -> one-hot -> exact stratified split -> partitioned write."""
    raw = _loader(in_path, null_tokens=()).load(spark)
    builder = TableBuilder(target=target, positive_label=positive_label, key=key, test_size=test_size,
                           seed=seed, drop_first=drop_first)
    write_split_table(builder.build(raw), out_path)
    return spark.read.parquet(out_path)


def explore(spark: SparkSession, in_path: str, out_dir: str, target: str = TARGET, top_n: int = 5, digits: int | None = None) -> dict:
    """Every report table (A1-A13, V1-V6) from one persisted input; ``digits`` rounds them."""
    df = _loader(in_path).load(spark).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        nums = numeric_columns(df)
        cats = [c for c in categorical_columns(df) if c != target]
        tables = {
            "summary": quality.summary(df),
            "missing": quality.missing_values_report(df),
            "cardinality": quality.cardinality_report(df),
            "numeric_stats": profile.numerical_summary(df, nums),
            "outliers": profile.outlier_summary(df, nums),
            "top_levels": profile.categorical_summary(df, top_n, cats) if cats else None,
            "correlation": correlation.heatmap_cells(df, "pearson", nums) if len(nums) > 1 else None,
            "histograms": chartdata.histogram(df, nums) if nums else None,
            "density": chartdata.density_curve(df, nums) if nums else None,
            "box_stats": chartdata.box_stats(df, target, nums) if target in df.columns and nums else None,
            "category_counts": chartdata.category_frequency(df, cats) if cats else None,
            "class_balance": chartdata.class_balance(df, target) if target in df.columns else None,
        }
        tables = {k: v for k, v in tables.items() if v is not None}
        return write_report(tables, out_dir, digits=digits)
    finally:
        df.unpersist()


def train(spark: SparkSession, table_path: str, out_dir: str, label: str = TARGET, models: str = "xgboost,mlp",
          tune: bool = True, scale_cols: list[str] | None = None, key: list[str] | None = None,
          params: dict[str, dict] | None = None, searches: dict[str, dict] | None = None,
          validation_share: float | None = None) -> dict:
    """Fit scaler+model pipelines, evaluate on the test split, log runs, keep the best.

    ``validation_share`` (F12) sets that share of the train split aside, and every baseline
    stops when its loss stops falling. The network stops early anyway, on a share of its own.
    ``params`` and ``searches`` override, per model name, the model's parameters and the
    arguments of its search; without them the full defaults run.
    """
    table = spark.read.parquet(table_path)
    features = [c for c in table.columns if c not in {label, "split", *(key or [])}]
    scale = [c for c in (scale_cols or NUMERICAL_COLUMNS) if c in features]
    trainset = table.where("split = 'train'").drop("split")
    if validation_share:
        trainset = holdout(trainset, validation_share, key=key, output=VALIDATION)
    trainset = trainset.persist(StorageLevel.MEMORY_AND_DISK)
    testset = table.where("split = 'test'").drop("split")
    log, ev, saved = RunLog(spark, os.path.join(out_dir, "runs")), Evaluator(), {}
    for name in select_models(models):
        own = (params or {}).get(name, {})
        if validation_share:
            stop = {"early_stopping_rounds": STOPPING_ROUNDS} if name == "xgboost" else {}
            own = {**stop, **own, "validation_col": VALIDATION}
        search = (searches or {}).get(name, {})
        model = build_pipeline(name, features, scale, label, **own).fit(trainset)
        run_name = f"{name}_baseline"
        metrics = ev.evaluate(run_name, predict(model, testset, keep=[label]), label)
        path = os.path.join(out_dir, "models", run_name)
        save_model(model, path)
        saved[run_name] = path
        log.log_run(run_name, name, "baseline", own, {k: metrics[k] for k in ("accuracy", "precision",
                                                                                "recall", "f1")}, {"model": path})
        if tune:
            from tabsmith.plans.tuning import TUNERS

            model, best, score, _ = TUNERS[name](trainset, features, scale, label, key=key, **search)
            run_name = f"{name}_tuned"
            metrics = ev.evaluate(run_name, predict(model, testset, keep=[label]), label)
            path = os.path.join(out_dir, "models", run_name)
            save_model(model, path)
            saved[run_name] = path
            log.log_run(run_name, name, "tuned", {**best, "cv_f1": score},
                        {k: metrics[k] for k in ("accuracy", "precision", "recall", "f1")}, {"model": path})
    trainset.unpersist()
    best_name = ev.best()
    best_path = os.path.join(out_dir, "models", "best")
    save_model(load_model(saved[best_name]), best_path)   # M10
    return {"best": best_name, "best_path": best_path, "models": saved, "metrics": ev.results}


def score(spark: SparkSession, model_path: str, in_path: str, out_path: str, key: list[str],
          threshold: float = 0.5) -> DataFrame:
    """Load the bundle, score the table on executors, write key + prediction."""
    model = load_model(model_path)
    df = spark.read.parquet(in_path)
    pred = predict(model, df, threshold, keep=key)
    write_predictions(pred, out_path, key)
    return spark.read.parquet(out_path)
