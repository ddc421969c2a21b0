"""Profiling aggregates.

Moments and extremes of all numeric columns come from one aggregate, centred powers
from a second. Quartiles: ``exact`` (default) selects the order statistics by
distributed refinement (``quantiles.column_quantiles``, no per-group value map);
``percentile`` uses Spark's single-pass exact aggregate (fine when distinct values
are few); ``approx`` uses ``percentile_approx`` sketches of fixed size. Interpolation
is linear, identical to pandas. The result is stacked to one row per column. Outlier fences are a one-row table
broadcast back, so the whole outlier count for all columns is a second single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import categorical_columns, col, numeric_columns, numeric_value, percent
from tabsmith.operators.frequency import frequency_table, level_shares, top_levels
from tabsmith.operators.quantiles import column_quantiles
from tabsmith.session import materialized

QUARTILES = (0.25, 0.5, 0.75)


def _quantile_expr(v, probs, method: str, accuracy: int):
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    if method == "percentile":
        return F.percentile(v, probs_arr)
    if method == "approx":
        return F.percentile_approx(v, probs_arr, accuracy)
    raise ValueError(f"unknown quantile method {method!r}")


def numeric_stats_row(df: DataFrame, columns: list[str], method: str = "exact",
                      accuracy: int = 10_000, moments: bool = True, quantiles: bool = True) -> DataFrame:
    """One-row frame with ``<stat><i>`` fields for every column ``i``.

    Pass 1: count, min, max and mean of every column (one aggregate). Quartiles: exact
    selection seeded with pass 1's n/min/max, or a sketch/percentile inside pass 1.
    Pass 2 (``moments``): sums of centred powers ``(x - mean)^2..4`` with the means as
    literals - plain sums, small enough for whole-stage codegen, and the numerically
    accurate two-pass form. The passes are actions on a (possibly cached) input; the
    result is a one-row frame of scalars. Skewness/kurtosis are the bias-corrected
    sample statistics; undefined cases are null, zero variance gives 0.
    """
    spark = df.sparkSession
    with materialized(df.select(*[col(c) for c in dict.fromkeys(columns)])) as d:   # caches no other column
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(columns):
            v = numeric_value(c, d)
            aggs += [F.count(v).alias(f"count{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}"),
                     F.avg(v).alias(f"mean{i}")]
            if quantiles and method != "exact":
                aggs.append(_quantile_expr(v, QUARTILES, method, accuracy).alias(f"q{i}"))
        first = d.agg(*aggs).first().asDict()
        if quantiles and method == "exact":
            seeds = {c: (first[f"count{i}"], first[f"min{i}"], first[f"max{i}"]) for i, c in enumerate(columns)}
            got = column_quantiles(d, columns, list(QUARTILES), seeds)
            for i, c in enumerate(columns):
                first[f"q{i}"] = got.get(c)
        elif not quantiles:
            for i, _ in enumerate(columns):
                first[f"q{i}"] = None
        second = {}
        if moments:
            sums = []
            for i, c in enumerate(columns):
                mu = first[f"mean{i}"]
                dv = numeric_value(c, d) - F.lit(mu if mu is not None else 0.0)
                sums += [F.sum(dv * dv).alias(f"s2_{i}"), F.sum(dv * dv * dv).alias(f"s3_{i}"),
                         F.sum(dv * dv * dv * dv).alias(f"s4_{i}")]
            second = d.agg(*sums).first().asDict()
    fields = [T.StructField("_rows", T.LongType())]
    values = [first["_rows"]]
    for i, _ in enumerate(columns):
        fields += [T.StructField(f"count{i}", T.LongType()), T.StructField(f"min{i}", T.DoubleType()),
                   T.StructField(f"max{i}", T.DoubleType()), T.StructField(f"mean{i}", T.DoubleType()),
                   T.StructField(f"q{i}", T.ArrayType(T.DoubleType()))]
        q = first[f"q{i}"]
        values += [first[f"count{i}"], first[f"min{i}"], first[f"max{i}"], first[f"mean{i}"],
                   [float(x) if x is not None else None for x in q] if q is not None else [None] * len(QUARTILES)]
        if moments:
            fields += [T.StructField(f"s{k}_{i}", T.DoubleType()) for k in (2, 3, 4)]
            values += [second[f"s{k}_{i}"] for k in (2, 3, 4)]
    row = spark.createDataFrame([tuple(values)], T.StructType(fields))
    if not moments:
        return row
    out = [F.col(f.name) for f in fields]
    for i in range(len(columns)):
        n = F.col(f"count{i}").cast("double")
        m2, m3, m4 = F.col(f"s2_{i}") / n, F.col(f"s3_{i}") / n, F.col(f"s4_{i}") / n
        g1 = m3 / F.pow(m2, 1.5)
        g2 = m4 / (m2 * m2) - 3.0
        flat = F.col(f"s2_{i}") == 0
        out += [
            F.when(n > 1, F.sqrt(F.col(f"s2_{i}") / (n - 1))).alias(f"std{i}"),
            F.when(n < 3, F.lit(None).cast("double")).when(flat, F.lit(0.0))
            .otherwise(F.sqrt(n * (n - 1)) / (n - 2) * g1).alias(f"skew{i}"),
            F.when(n < 4, F.lit(None).cast("double")).when(flat, F.lit(0.0))
            .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias(f"kurt{i}"),
        ]
    return row.select(*out)


def numerical_summary(df: DataFrame, columns: list[str] | None = None, method: str = "exact",
                      accuracy: int = 10_000, quantiles: bool = True) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max, skew, kurtosis)``.

    Sample std (ddof 1), bias-corrected skewness and excess kurtosis, missing/NaN
    ignored; undefined statistics are null. Full precision (round in the report).
    ``quantiles=False`` skips the quartiles (null) when only moments are wanted.
    """
    columns = columns if columns is not None else numeric_columns(df)
    row = numeric_stats_row(df, columns, method, accuracy, quantiles=quantiles)
    structs = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"count{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"),
            F.col(f"q{i}")[0].alias("q25"), F.col(f"q{i}")[1].alias("q50"), F.col(f"q{i}")[2].alias("q75"),
            F.col(f"max{i}").alias("max"), F.col(f"skew{i}").alias("skew"), F.col(f"kurt{i}").alias("kurtosis"),
        )
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*structs)))


def categorical_summary(df: DataFrame, top_n: int = 5, columns: list[str] | None = None) -> DataFrame:
    """A10: ``(column, value, cnt, rank)`` top-N levels of every string column."""
    columns = columns if columns is not None else categorical_columns(df)
    return top_levels(frequency_table(df, columns), top_n)


def fences(df: DataFrame, columns: list[str], k: float = 1.5, method: str = "exact",
           accuracy: int = 10_000) -> DataFrame:
    """One-row frame ``lo<i>, hi<i>`` = Q1 - k IQR, Q3 + k IQR per column (plus quartiles)."""
    row = numeric_stats_row(df, columns, method, accuracy, moments=False)
    sel = [F.col("_rows")]
    for i, _ in enumerate(columns):
        q1, q3 = F.col(f"q{i}")[0], F.col(f"q{i}")[2]
        sel += [(q1 - F.lit(k) * (q3 - q1)).alias(f"lo{i}"), (q3 + F.lit(k) * (q3 - q1)).alias(f"hi{i}")]
    return row.select(*sel)


def outliers_iqr(df: DataFrame, column: str, k: float = 1.5, keep: list[str] | None = None,
                 method: str = "exact") -> DataFrame:
    """Rows with ``value < lo`` or ``value > hi`` (strict); missing never flagged.

    Returns ``keep`` columns (default: just the column, like the reference) - pass key
    columns to keep row identity. The fence row is broadcast (one row, fixed size).
    """
    f = fences(df, [column], k, method).first()      # two scalars, used as literals
    v = numeric_value(column, df)
    cols = keep if keep is not None else [column]
    flagged = df.where((v < F.lit(f["lo0"])) | (v > F.lit(f["hi0"])))
    return flagged.select(*[col(c) for c in cols])


def outlier_summary(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                    method: str = "exact") -> DataFrame:
    """``(column, n_outliers, pct_outliers)`` for all numeric columns, count desc.

    Two passes in total however many columns: (1) all quartiles, (2) all counts. The
    percentage is over *all* rows (missing included), null on empty input.
    """
    columns = columns if columns is not None else numeric_columns(df)
    f = fences(df, columns, k, method).first()       # 2 scalars per column, used as literals
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        v = numeric_value(c, df)
        aggs.append(F.count_if((v < F.lit(f[f"lo{i}"])) | (v > F.lit(f[f"hi{i}"]))).alias(f"n{i}"))
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_outliers"),
                        percent(F.col(f"n{i}"), F.col("_rows")).alias("pct_outliers"))
               for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*structs))).orderBy(F.desc("n_outliers"), "column")


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """``(value, cnt, share)`` of one column, share over non-missing rows, desc."""
    return level_shares(df, column).orderBy(F.desc("cnt"), "value")
