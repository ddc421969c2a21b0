"""Chart data (V1-V7): the small tables behind each picture, computed on executors.

Rendering is left to the caller; every function returns a frame whose size depends on
bins, levels or classes, not directly on the number of rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.columns import col, numeric_columns, numeric_value
from tabsmith.operators.frequency import frequency_table, level_shares, unpivot_values
from tabsmith.operators.quantiles import exact_quantiles, large_group_quantiles, small_groups, with_quantiles
from tabsmith.session import cut_lineage

FEW_GROUPS = 4096              # (column, class) groups whose quartiles the driver guides
BINS_PER_TASK = 1_000_000      # histogram bins made by one task
BINS_PER_BANDWIDTH = 20
KERNEL_REACH = 40              # bandwidths; exp(-40 * 40 / 2) is zero in doubles


def _auto_bins_params(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: ``lo, hi, bins`` with numpy's 'auto' rule.

    width = min(Freedman-Diaconis, Sturges) (Sturges alone when IQR = 0);
    bins = ceil((hi - lo) / width); equal lo and hi widen to lo - 0.5, hi + 0.5.
    """
    long = unpivot_values(df, columns, "double").withColumnRenamed("value", "v")
    quart = {r["column"]: list(r["q"]) for r in exact_quantiles(long, ["column"], [0.25, 0.75]).collect()}
    aggs = []
    for i, c in enumerate(columns):
        v = numeric_value(c, df)
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    row = df.agg(*aggs).select("*", *[
        (F.array(*[F.lit(float(x)) for x in quart[c]]) if c in quart
         else F.array(F.lit(None).cast("double"), F.lit(None).cast("double"))).alias(f"q{i}")
        for i, c in enumerate(columns)])
    structs = []
    for i, c in enumerate(columns):
        n = F.col(f"n{i}").cast("double")
        same = F.col(f"lo{i}") == F.col(f"hi{i}")
        lo = F.when(same, F.col(f"lo{i}") - 0.5).otherwise(F.col(f"lo{i}"))
        hi = F.when(same, F.col(f"hi{i}") + 0.5).otherwise(F.col(f"hi{i}"))
        iqr = F.col(f"q{i}")[1] - F.col(f"q{i}")[0]
        sturges = (F.col(f"hi{i}") - F.col(f"lo{i}")) / (F.log2(n) + 1.0)
        fd = 2.0 * iqr * F.pow(n, F.lit(-1.0 / 3.0))
        width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
        bins = F.when(width > 0, F.ceil((hi - lo) / width)).otherwise(F.lit(1)).cast("long")
        structs.append(F.struct(F.lit(c).alias("column"), n.cast("long").alias("n"), lo.alias("lo"),
                                hi.alias("hi"), bins.alias("bins")))
    return row.select(F.inline(F.array(*structs))).where("n > 0")


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int | None = None,
              empty_bins: bool = True) -> DataFrame:
    """V1: ``(column, bin, lo, hi, cnt)``, equal-width bins, last bin closed, zero-filled.

    Pass 1 (one aggregate) fixes range and bin count per column; pass 2 assigns each
    value ``least(floor((v - lo) * bins / (hi - lo)), bins - 1)`` and counts with a
    partial aggregate. The bins come from ``spark.range``, so however many the rule asks
    for, no task holds them all; ``empty_bins=False`` leaves out those without a value.
    A column with an infinite value has no bin width and raises ``ValueError``.
    """
    columns = columns if columns is not None else numeric_columns(df)
    spark = df.sparkSession
    df = df.select(*[col(c) for c in columns])
    params = _auto_bins_params(df, columns).collect() if columns else []     # one row a column
    if not params:
        return spark.createDataFrame([], "column string, bin long, lo double, hi double, cnt long")
    cells, grids, edges, at = [], [], [], F.col("bin")
    for p in params:
        c, lo, hi, k = p["column"], p["lo"], p["hi"], int(bins if bins is not None else p["bins"])
        if not math.isfinite(hi - lo):
            raise ValueError(f"column {c!r} has no finite range")
        v = numeric_value(c, df)
        idx = F.floor((v - F.lit(lo)) * F.lit(k / (hi - lo))).cast("long")
        idx = F.least(F.greatest(idx, F.lit(0)), F.lit(k - 1)).cast("long")
        cells.append(F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), idx).alias("bin")))
        step = (hi - lo) / k
        edges.append(F.when(F.col("column") == c, F.struct(
            (F.lit(lo) + at * F.lit(step)).alias("lo"),
            F.when(at == k - 1, F.lit(hi)).otherwise(F.lit(lo) + (at + 1) * F.lit(step)).alias("hi"))))
        if empty_bins:
            grids.append(spark.range(0, k, 1, -(-k // BINS_PER_TASK))
                         .select(F.lit(c).alias("column"), F.col("id").alias("bin")))
    out = df.select(F.inline(F.array(*cells))).where("bin IS NOT NULL") \
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("cnt"))
    if empty_bins:
        out = reduce(DataFrame.unionByName, grids).join(out, ["column", "bin"], "left")
    return out.withColumn("edge", F.coalesce(*edges)).select(
        "column", "bin", "edge.lo", "edge.hi", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"))


def density_curve(df: DataFrame, columns: list[str] | None = None, points: int = 200) -> DataFrame:
    """V2: Gaussian KDE (Scott bandwidth) at ``points`` grid points between min and max.

    Values are gathered in bins of a twentieth of the bandwidth. Each non-empty bin keeps
    its count and the sums of the first four powers of the distance ``d`` to its centre;
    with the Hermite polynomials ``exp(-(z - d)^2 / 2) = exp(-z^2 / 2) * sum He_k(z) d^k / k!``
    they give the kernel sum to 1e-10 of the kernel's peak, whatever the range of the column. A bin
    reaches only the points within 40 bandwidths, beyond which the kernel is zero in doubles.
    The cost after one pass over the rows is non-empty bins x points in reach.
    Columns with fewer than two values, no spread or an infinite value have no curve.
    """
    columns = columns if columns is not None else numeric_columns(df)
    spark = df.sparkSession
    df = df.select(*[col(c) for c in columns])
    aggs = []
    for i, c in enumerate(columns):
        v = numeric_value(c, df)
        aggs += [F.count(v).alias(f"n{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    row = df.agg(*aggs).first() if columns else {}                            # one row of scalars
    values, grid = [], []
    for i, c in enumerate(columns):
        n, s, lo, hi = (row[f"{f}{i}"] for f in ("n", "s", "lo", "hi"))
        if n < 2 or not math.isfinite(s) or s <= 0 or not math.isfinite(hi - lo):
            continue
        bw = s * n ** -0.2                    # Scott's factor times the sample deviation
        u = (numeric_value(c, df) - F.lit(lo)) / F.lit(bw)
        gap = (hi - lo) / (points - 1)
        values.append(F.struct(F.lit(c).alias("column"), u.alias("u"), F.lit(gap / bw).alias("gap")))
        grid += [(c, j, lo + j * (hi - lo) / (points - 1), n * bw * math.sqrt(2 * math.pi)) for j in range(points)]
    if not values:
        return spark.createDataFrame([], "column string, i int, x double, density double")
    centre = (F.col("b") + 0.5) / BINS_PER_BANDWIDTH
    d = F.col("u") - centre
    binned = df.select(F.inline(F.array(*values))).where(F.col("u").isNotNull()) \
        .withColumn("b", F.floor(F.col("u") * BINS_PER_BANDWIDTH)).withColumn("d", d) \
        .groupBy("column", "gap", "b").agg(
            F.count(F.lit(1)).alias("m0"), F.sum("d").alias("m1"), F.sum(F.expr("d * d")).alias("m2"),
            F.sum(F.expr("d * d * d")).alias("m3"), F.sum(F.expr("d * d * d * d")).alias("m4"))
    first = F.greatest(F.ceil((centre - KERNEL_REACH) / F.col("gap")), F.lit(0)).cast("int")
    last = F.least(F.floor((centre + KERNEL_REACH) / F.col("gap")), F.lit(points - 1)).cast("int")
    reach = binned.withColumns({"c": centre, "first": first, "last": last}).where("first <= last") \
        .withColumn("i", F.explode(F.sequence("first", "last"))).withColumn("z", F.expr("i * gap - c"))
    kernel = F.expr("exp(-0.5D * z * z) * (m0 + z * m1 + (z * z - 1) * m2 / 2 + (z * z - 3) * z * m3 / 6"
                    " + (z * z * (z * z - 6) + 3) * m4 / 24)")
    sums = reach.groupBy("column", "i").agg(F.sum(kernel).alias("s"))
    return spark.createDataFrame(grid, "column string, i int, x double, norm double") \
        .join(sums, ["column", "i"], "left") \
        .select("column", "i", "x", (F.coalesce("s", F.lit(0.0)) / F.col("norm")).alias("density")) \
        .orderBy("column", "i")


def box_stats(df: DataFrame, target: str, columns: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """V3: per (column, class): ``q1, median, q3, whislo, whishi, n_fliers, n``.

    Whiskers are the most extreme values inside the 1.5 IQR fences (matplotlib's
    rule); fliers are counted, not listed. With up to ``FEW_GROUPS`` (column, class) groups
    the quartiles come from refinement guided by the driver and are broadcast back; with
    more, one shuffle deals the rows by group, and a group's rows are sorted and measured
    in one task. The few groups too large for that are cut by distributed prefix counts.
    """
    columns = columns if columns is not None else [c for c in numeric_columns(df) if c != target]
    long = df.select(col(target).alias("class"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), numeric_value(c, df).alias("v")) for c in columns
    ]))).where(F.col("v").isNotNull() & F.col("class").isNotNull())
    few = df.select(col(target)).distinct().limit(FEW_GROUPS + 1).count() * len(columns) <= FEW_GROUPS
    keys, probs = ["column", "class"], [0.25, 0.5, 0.75]
    if few:
        return _boxes(long, exact_quantiles(long, keys, probs), k)
    small, large = small_groups(long, keys)
    rows = _with_fences(with_quantiles(small, keys, probs), k)
    inside = (F.col("v") >= F.col("lo_f")) & (F.col("v") <= F.col("hi_f"))
    out = rows.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3")], F.min(F.when(inside, F.col("v"))).alias("whislo"),
        F.max(F.when(inside, F.col("v"))).alias("whishi"), F.count_if(~inside).alias("n_fliers"), F.first("n").alias("n"))
    if large is None:
        return out
    return out.unionByName(_boxes(large, cut_lineage(large_group_quantiles(large, keys, probs)), k))   # read twice


def _with_fences(q: DataFrame, k: float) -> DataFrame:
    q = q.withColumns({"q1": F.col("q")[0], "median": F.col("q")[1], "q3": F.col("q")[2]}).drop("q")
    return q.withColumns({"lo_f": F.col("q1") - k * (F.col("q3") - F.col("q1")), "hi_f": F.col("q3") + k * (F.col("q3") - F.col("q1"))})


def _boxes(long: DataFrame, quartiles: DataFrame, k: float) -> DataFrame:
    """The rows of ``box_stats`` from ``long`` and a small table of its groups' quartiles."""
    q = _with_fences(quartiles, k)
    inside = (F.col("v") >= F.col("lo_f")) & (F.col("v") <= F.col("hi_f"))
    fences = q.select(F.col("column").alias("_column"), F.col("class").alias("_class"), "lo_f", "hi_f")
    same = (F.col("column") == F.col("_column")) & (F.col("class") == F.col("_class"))
    ext = long.join(F.broadcast(fences), same, "inner").groupBy("_column", "_class").agg(
        F.min(F.when(inside, F.col("v"))).alias("whislo"),
        F.max(F.when(inside, F.col("v"))).alias("whishi"),
        F.count_if(~inside).alias("n_fliers"))
    return q.join(ext, same, "inner").select(
        "column", "class", "q1", "median", "q3", "whislo", "whishi", "n_fliers", "n")


def category_frequency(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """V4/O3: every level of every string column with its count, ordered by count desc."""
    return frequency_table(df, columns).orderBy("column", F.desc("cnt"), "value")


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """V6: ``(value, cnt, share)`` per class."""
    return level_shares(df, target).orderBy(F.desc("cnt"), "value")
