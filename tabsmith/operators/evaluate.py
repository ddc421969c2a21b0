"""Classification metrics (E1-E7, V7) from one aggregate of confusion cells.

Binary precision/recall/F1 are for the positive class 1 (Spark ML's ``f1`` is the
weighted F1, which is a different number); undefined ratios are 0 like the
reference's library default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.columns import col


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_cells(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                    labels: list | None = None) -> DataFrame:
    """``(label, prediction, cnt)`` for every pair of labels, zero-filled.

    Labels default to those seen in either column; the square of their number is the
    size of the result.
    """
    counts = pred.groupBy(col(label).alias("label"), col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("cnt"))
    if labels is None:
        seen = counts.select(F.col("label").alias("v")).union(counts.select(F.col("prediction").alias("v"))) \
            .where(F.col("v").isNotNull()).groupBy().agg(F.sort_array(F.collect_set("v")).alias("vs"))
        grid = seen.select(F.explode("vs").alias("label"), "vs").select("label", F.explode("vs").alias("prediction"))
    else:
        dtype = pred.schema[label].dataType.simpleString()
        grid = pred.sparkSession.createDataFrame([(a, b) for a in labels for b in labels],
                                                 f"label {dtype}, prediction {dtype}")
    return grid.join(counts, ["label", "prediction"], "left") \
        .select("label", "prediction", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"))


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   positive=1) -> DataFrame:
    """E1-E4 in one row: ``n, tp, fp, fn, tn, accuracy, precision, recall, f1``."""
    y, p = col(label), col(prediction)
    pos = F.lit(positive)
    row = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == pos) & (p == pos)).alias("tp"),
        F.count_if((y != pos) & (p == pos)).alias("fp"),
        F.count_if((y == pos) & (p != pos)).alias("fn"),
        F.count_if((y != pos) & (p != pos)).alias("tn"),
        F.count_if(y == p).alias("correct"),
    )
    return row.select(
        "n", "tp", "fp", "fn", "tn",
        _ratio(F.col("correct"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E5: ``(class, precision, recall, f1, support)`` per class, then the rows
    ``accuracy``, ``macro avg`` and ``weighted avg`` (class as text)."""
    cells = pred.groupBy(col(label).alias("label"), col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("cnt")).where("label IS NOT NULL AND prediction IS NOT NULL")
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("k"), F.col("cnt").alias("support"), F.lit(0).cast("long").alias("npred"),
                 F.when(F.col("label") == F.col("prediction"), F.col("cnt")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("k"), F.lit(0).cast("long").alias("support"), F.col("cnt").alias("npred"),
                 F.lit(0).cast("long").alias("tp")))))
    per = sides.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("support", "npred", "tp")])
    per = per.select(
        F.col("k").cast("string").alias("class"), "support",
        _ratio(F.col("tp"), F.col("npred")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("npred") + F.col("support")).alias("f1"),
        F.col("tp"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
                  F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1").alias("sf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = _ratio(F.col("tp"), F.col("n"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), (F.col("sp") / F.col("k")).alias("precision"),
                 (F.col("sr") / F.col("k")).alias("recall"), (F.col("sf") / F.col("k")).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _ratio(F.col("wp"), F.col("n")).alias("precision"),
                 _ratio(F.col("wr"), F.col("n")).alias("recall"), _ratio(F.col("wf"), F.col("n")).alias("f1"),
                 F.col("n").alias("support")),
    )))
    return per.select("class", "precision", "recall", "f1", "support").unionByName(summary)


class Evaluator:
    """Keep one metrics row per model in insertion order; ``compare`` as a frame."""

    def __init__(self) -> None:
        self.results: dict[str, dict] = {}

    def evaluate(self, name: str, pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
        """Metrics and the 2x2 cells of a 0/1 classifier from one aggregate (one job)."""
        row = model_metrics(pred, label, [(name, prediction)]).first().asDict()
        row.pop("run_order")
        row.pop("model")
        row["confusion"] = {(0, 0): row["tn"], (0, 1): row["fp"], (1, 0): row["fn"], (1, 1): row["tp"]}
        self.results[name] = row
        return row

    def compare(self, spark) -> DataFrame:
        rows = [(i, name, m["accuracy"], m["precision"], m["recall"], m["f1"])
                for i, (name, m) in enumerate(self.results.items())]
        return spark.createDataFrame(
            rows, "run_order int, model string, accuracy double, precision double, recall double, f1 double")

    def confusion_frame(self, spark) -> DataFrame:
        """V7: cells of every evaluated model, keyed by model name."""
        rows = [(name, int(k[0]), int(k[1]), int(v)) for name, m in self.results.items()
                for k, v in m["confusion"].items()]
        return spark.createDataFrame(rows, "model string, label int, prediction int, cnt long")

    def best(self) -> str | None:
        """Highest F1, first inserted wins ties."""
        best_name, best_f1 = None, None
        for name, m in self.results.items():
            if best_f1 is None or m["f1"] > best_f1:
                best_name, best_f1 = name, m["f1"]
        return best_name


def _prediction_columns(predictions) -> list[tuple[str, object]]:
    if isinstance(predictions, dict):
        items = list(predictions.items())
    else:  # column names (model = column) or (name, column) pairs
        items = [(p, p) if isinstance(p, str) else tuple(p) for p in predictions]
    if not items:
        raise ValueError("no models to compare")
    names = [n for n, _ in items]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate model names: {names}")
    return [(n, col(p) if isinstance(p, str) else p) for n, p in items]


def model_metrics(pred: DataFrame, label: str, predictions, positive=1) -> DataFrame:
    """``(run_order, model, n, tp, fp, fn, tn, accuracy, precision, recall, f1)``.

    ``predictions`` maps model name -> prediction column, or lists column names or
    ``(name, column)`` pairs; the given order is the run order. Every model is scored in ONE aggregate over the
    scored table (partial on the map side, one tiny final row), stacked with ``inline``;
    adding a model adds four counters, not a job.
    """
    items = _prediction_columns(predictions)
    y, pos = col(label), F.lit(positive)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (_, p) in enumerate(items):
        aggs += [F.count_if((y == pos) & (p == pos)).alias(f"tp{i}"),
                 F.count_if((y != pos) & (p == pos)).alias(f"fp{i}"),
                 F.count_if((y == pos) & (p != pos)).alias(f"fn{i}"),
                 F.count_if((y != pos) & (p != pos)).alias(f"tn{i}")]
    row = pred.agg(*aggs)
    long = row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("run_order"), F.lit(name).alias("model"), F.col("n").alias("n"),
                 *[F.col(f"{k}{i}").alias(k) for k in ("tp", "fp", "fn", "tn")])
        for i, (name, _) in enumerate(items)
    ])))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    return long.select(
        "run_order", "model", "n", "tp", "fp", "fn", "tn",
        _ratio(tp + tn, F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def model_confusion(pred: DataFrame, label: str, predictions, positive=1, negative=0) -> DataFrame:
    """V7: ``(model, label, prediction, cnt)``, the 2x2 cells of every model, zero-filled.

    Derived from :func:`model_metrics` (same single pass); rows whose label or
    prediction is neither class count in no cell.
    """
    m = model_metrics(pred, label, predictions, positive)
    pos, neg = F.lit(positive), F.lit(negative)
    cells = F.array(*[
        F.struct(a.alias("label"), b.alias("prediction"), F.col(k).alias("cnt"))
        for a, b, k in ((neg, neg, "tn"), (neg, pos, "fp"), (pos, neg, "fn"), (pos, pos, "tp"))
    ])
    return m.select("model", F.inline(cells))


def best_model(metrics: DataFrame, metric: str = "f1") -> DataFrame:
    """The row with the highest ``metric``; the earliest run wins ties."""
    return metrics.orderBy(F.desc(metric), F.asc("run_order")).limit(1)
