"""Hyper-parameter search (M7-M9).

* ``tune_xgboost``: ``n_iter`` candidates sampled without replacement from the reference's
  972-point grid (seeded), 3-fold cross-validation on class-balanced folds from
  :func:`assign_folds`, metric = binary F1 of class 1. The boosters of all candidates and
  folds grow from the same passes over one set of blocks (:func:`boosting.boost`).
* ``tune_mlp``: at most 6 sampled candidates of the 24-point grid (layers, step, dropout,
  batch), trained side by side in the same epochs, scored on an exact hold-out (F11);
  strict ``>`` keeps the first best.
* ``tune_gbt``: the same search over Spark's own trees with its ``CrossValidator``.

The best is refit on all training rows.
"""

from __future__ import annotations

import itertools
import random

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators.evaluate import model_metrics
from tabsmith.operators.split import assign_folds, holdout
from tabsmith.plans import boosting, network
from tabsmith.plans.models import GBT_DEFAULTS, build_pipeline, mlp, with_weights

# The reference's search spaces and the limits of its search.
GBT_GRID = {
    "n_estimators": [150, 300, 450],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.03, 0.1, 0.2],
    "subsample": [0.7, 0.9],
    "colsample_bytree": [0.7, 0.9],
    "min_child_weight": [1, 3, 5],
    "scale_pos_weight": [1, 2, 3],
}
MLP_GRID = {
    "hidden_layer_sizes": [(256, 128, 64, 32), (128, 64, 32), (256, 128)],
    "learning_rate_init": [1e-4, 5e-4],
    "dropout_rate": [0.2, 0.4],
    "batch_size": [32, 64],
}
MLP_SEARCH = {"max_iter": 300, "n_iter_no_change": 10}
MLP_REFIT = {"max_iter": 500, "n_iter_no_change": 15}


def sample_grid(grid: dict[str, list], n: int, seed: int) -> list[dict]:
    """``n`` distinct grid points chosen with a seeded sampler (all points if fewer)."""
    keys = list(grid)
    sizes = [len(grid[k]) for k in keys]
    total = 1
    for s in sizes:
        total *= s
    picks = random.Random(seed).sample(range(total), min(n, total))
    out = []
    for idx in picks:
        combo, rest = {}, idx
        for k, s in zip(reversed(keys), reversed(sizes)):
            combo[k] = grid[k][rest % s]
            rest //= s
        out.append({k: combo[k] for k in keys})
    return out


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def tune_gbt(train: DataFrame, feature_cols: list[str], scale_cols: list[str], label: str = "label",
             n_iter: int = 8, folds: int = 3, seed: int = 42, key: list[str] | None = None,
             grid: dict | None = None, parallelism: int = 2):
    """M7/M9: returns ``(best PipelineModel, best params, best mean CV F1, results rows)``."""
    candidates = [{**{k: GBT_DEFAULTS[k] for k in GBT_GRID}, **c} for c in sample_grid(grid or GBT_GRID, n_iter, seed)]
    data = with_weights(assign_folds(train, folds, seed, label, key, "fold"), label,
                        [c["scale_pos_weight"] for c in candidates])
    pipe = build_pipeline("gbt", feature_cols, scale_cols, label)
    clf = pipe.getStages()[-1]
    maps = []
    for c in candidates:
        m = {clf.maxIter: int(c["n_estimators"]), clf.maxDepth: int(c["max_depth"]),
             clf.stepSize: float(c["learning_rate"]), clf.subsamplingRate: float(c["subsample"]),
             clf.featureSubsetStrategy: str(float(c["colsample_bytree"])),
             clf.minInstancesPerNode: int(c["min_child_weight"])}
        if float(c["scale_pos_weight"]) != 1.0:
            m[clf.weightCol] = f"_w{float(c['scale_pos_weight'])}"
        maps.append(m)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=f1_evaluator(label),
                        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=seed)
    model = cv.fit(data)
    scores = list(model.avgMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    rows = [(i, {k: str(v) for k, v in c.items()}, float(scores[i])) for i, c in enumerate(candidates)]
    return model.bestModel, candidates[best], float(scores[best]), rows


def _f1_counts(block: boosting.Block, boosters: list[boosting.Booster]) -> dict[int, np.ndarray]:
    """(tp, fp, fn) of every booster on the fold it never saw."""
    out = {}
    for k, b in enumerate(boosters):
        held = block.fold == b.without
        said, true = block.margin[held, k] >= 0, block.y[held] > 0
        out[k] = np.array([(said & true).sum(), (said & ~true).sum(), (~said & true).sum()])
    return out


def cross_validate(data: DataFrame, candidates: list[dict], folds: int, seed: int = 42) -> tuple[list[list[float]], int]:
    """F1 of every candidate on every fold of ``data`` (y, fold, x), and the passes over it."""
    configs = [(boosting.settings(**{"random_state": seed, **c}), k) for c in candidates for k in range(folds)]
    _, _, counts, passes = boosting.boost(data, configs, measure=_f1_counts)
    f1 = []
    for i in range(len(configs)):
        tp, fp, fn = counts.get(i, np.zeros(3))
        f1.append(float(2 * tp / (2 * tp + fp + fn)) if tp else 0.0)
    return [f1[i:i + folds] for i in range(0, len(f1), folds)], passes


def tune_xgboost(train: DataFrame, feature_cols: list[str], scale_cols: list[str], label: str = "label", n_iter: int = 8,
                 folds: int = 3, seed: int = 42, key: list[str] | None = None, grid: dict | None = None):
    """M7/M9: returns ``(best PipelineModel, best params, best mean CV F1, results rows)``."""
    candidates = sample_grid(grid or GBT_GRID, n_iter, seed)
    marked = assign_folds(train, folds, seed, label, key, "_fold")
    prepared = Pipeline(stages=build_pipeline("xgboost", feature_cols, scale_cols, label).getStages()[:-1]).fit(marked).transform(marked)
    scores, _ = cross_validate(boosting.training_rows(prepared, label, "features", F.col("_fold")), candidates, folds, seed)
    mean = [sum(s) / len(s) for s in scores]
    best = max(range(len(mean)), key=lambda i: (mean[i], -i))
    final = build_pipeline("xgboost", feature_cols, scale_cols, label, **{"random_state": seed, **candidates[best]}).fit(train)
    rows = [(i, {k: str(v) for k, v in c.items()}, mean[i]) for i, c in enumerate(candidates)]
    return final, candidates[best], mean[best], rows


def tune_mlp(train: DataFrame, feature_cols: list[str], scale_cols: list[str], label: str = "label",
             max_candidates: int = 6, seed: int = 42, key: list[str] | None = None, grid: dict | None = None,
             search: dict | None = None, refit: dict | None = None):
    """M8/M9: bounded grid on an exact 20% hold-out. ``search`` and ``refit`` override the
    settings of the candidates' fits and of the last one."""
    candidates = sample_grid(grid or MLP_GRID, max_candidates, seed)
    marked = holdout(train, 0.2, seed, key, "_val")
    prepared = Pipeline(stages=build_pipeline("mlp", feature_cols, scale_cols, label).getStages()[:-1]).fit(train).transform(marked)
    fits = [{**MLP_SEARCH, "random_state": seed, **c, **(search or {})} for c in candidates]
    models = mlp(label).fit_many(prepared.where("NOT _val"), fits)
    scored = prepared.where("_val").select(F.col(f"`{label}`").alias("label"), "features")
    for i, model in enumerate(models):
        scored = model.transform(scored).withColumn(f"m{i}", F.col("prediction").cast("int")).drop("probability", "prediction")
    f1 = {r["model"]: r["f1"] for r in model_metrics(scored, "label", [f"m{i}" for i in range(len(models))]).collect()}
    scores = [float(f1[f"m{i}"]) for i in range(len(models))]
    best = scores.index(max(scores))                       # the first best wins ties
    final = build_pipeline("mlp", feature_cols, scale_cols, label,
                           **{**MLP_REFIT, "random_state": seed, **candidates[best], **(refit or {})}).fit(train)
    rows = [(i, {k: str(v) for k, v in c.items()}, scores[i]) for i, c in enumerate(candidates)]
    return final, candidates[best], scores[best], rows


TUNERS = {"xgboost": tune_xgboost, "mlp": tune_mlp, "gbt": tune_gbt}


def sample_grid_size(grid: dict[str, list]) -> int:
    return len(list(itertools.product(*grid.values())))


def results_frame(spark, rows: list) -> DataFrame:
    """M9 as a table: ``(candidate, params map<string,string>, f1)``, one row per candidate."""
    return spark.createDataFrame(rows, "candidate int, params map<string,string>, f1 double")


def tune_holdout(lineitem: DataFrame, name: str, **search) -> DataFrame:
    """M7/M8 on the train split of ``lineitem`` (label: returned flag 'R'); returns the M9
    table. ``search`` goes to the model's tuner (grid, candidates, settings); without it the
    full default search runs."""
    from pyspark import StorageLevel

    from tabsmith.operators.split import assign_split
    from tabsmith.session import materialized

    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    data = lineitem.select(*key, *feats, (F.col("l_returnflag") == "R").cast("int").alias("label"))
    with materialized(data) as d:
        train = assign_split(d, 0.2, 42, "label", key).where("split = 'train'").drop("split") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _, _, _, rows = TUNERS[name](train, feats, feats, "label", key=key, **search)
        finally:
            train.unpersist()
    return results_frame(lineitem.sparkSession, rows)
