"""Exact quantiles by distributed selection (used by A7, A11, A12, V1, V3).

Spark's exact ``percentile`` keeps a value -> count map per group, so a continuous
column at scale pushes all of its distinct values through one task. Here each needed
order statistic is found by refinement instead:

1. one aggregate gives ``n, min, max`` per group; the ranks needed for linear
   interpolation (``p * (n - 1)``, floor and ceiling) become targets;
2. each round counts the rows of every open value window in ``buckets`` buckets
   (``groupBy(window, bucket)`` - map-side aggregated, at most ``buckets`` rows per window
   reach the driver) and each target descends into the bucket holding its rank. The
   first ``LINEAR_ROUNDS`` rounds cut a finite window evenly; later ones, and windows of
   infinite width, cut the order-preserving 64-bit pattern of the doubles into
   ``PATTERN_BUCKETS`` runs. Each of those settles 6 bits, so any data takes at most
   ``MAX_ROUNDS`` rounds;
3. a bucket with one distinct value resolves its targets; a bucket with at most
   ``list_limit`` rows is listed as ``(value, count)`` and resolved exactly.

Equal values never need splitting (they are one value), so a value holding a third of
the rows costs nothing extra. The result is the same number Spark's ``percentile``
returns: ``(hi - pos) * v_lo + (pos - lo) * v_hi``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import numeric_value
from tabsmith.operators.frequency import unpivot_values
from tabsmith.operators.ranking import _count_at_or_below, prefix_before

BUCKETS = 1024
COLUMN_BUCKETS = 4096    # of each column, where whole columns are cut
LIST_LIMIT = 20_000
LINEAR_ROUNDS = 2
PATTERN_BUCKETS = 64
GROUP_ROWS = 200_000     # of many groups, those up to this size are sorted by one task each
MAX_ROUNDS = LINEAR_ROUNDS + 11  # 64 bits, 6 a round


def _ordinal(x: float) -> int:
    """Position of a double among all doubles in ascending order."""
    bits = int(np.float64(x + 0.0).view(np.int64))
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _double(ordinal: int) -> float:
    bits = ordinal if ordinal >= 0 else (-ordinal) | (1 << 63)
    return float(np.uint64(bits).view(np.float64))


def split_points(a: float, b: float, buckets: int) -> list[float]:
    """``buckets - 1`` doubles that cut [a, b] into runs of equally many doubles."""
    lo, hi = _ordinal(a), _ordinal(b)
    return [_double(lo + -(-(hi - lo + 1) * i // buckets)) for i in range(1, buckets)]


def _bucket_frame(spark, windows: dict, keys: list[str], key_types: list[T.DataType], linear: bool) -> DataFrame:
    """The windows with their split points (null: cut evenly); one row a window."""
    fields = [T.StructField("_wid", T.LongType())] + [T.StructField(k, t) for k, t in zip(keys, key_types)] + \
        [T.StructField("_a", T.DoubleType()), T.StructField("_b", T.DoubleType()),
         T.StructField("_points", T.ArrayType(T.DoubleType()))]
    rows = [(wid, *kv, a, b, None if linear and math.isfinite(b - a) else split_points(a, b, PATTERN_BUCKETS))
            for wid, (kv, a, b) in windows.items()]
    return spark.createDataFrame(rows, T.StructType(fields))


def _window_frame(spark, windows: dict, keys: list[str], key_types: list[T.DataType]) -> DataFrame:
    fields = [T.StructField("_wid", T.LongType())] + [T.StructField(k, t) for k, t in zip(keys, key_types)] + \
        [T.StructField("_a", T.DoubleType()), T.StructField("_b", T.DoubleType())]
    rows = [(wid, *kv, a, b) for wid, (kv, a, b) in windows.items()]
    return spark.createDataFrame(rows, T.StructType(fields))


def _in_windows(long: DataFrame, frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``long`` inside their group's windows (a window table is small: broadcast)."""
    cond = [long[k].eqNullSafe(frame[k]) for k in keys]
    cond.append(long["v"].between(frame["_a"], frame["_b"]))
    return long.join(F.broadcast(frame), cond, "inner").select(
        "_wid", long["v"].alias("v"), "_a", "_b", *[c for c in frame.columns if c == "_points"])


def exact_quantiles(long: DataFrame, keys: list[str], probs: list[float], buckets: int = BUCKETS,
                    list_limit: int = LIST_LIMIT, stats: dict | None = None) -> DataFrame:
    """``keys + [n, q]``: exact interpolated quantiles of ``v`` per key group.

    ``long`` holds the key columns and a non-null double column ``v``. ``stats`` may
    pass ``{group tuple: (n, min, max)}`` already computed by the caller.
    """
    key_types = [long.schema[k].dataType for k in keys]
    if stats is None:
        rows = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("v").alias("_mn"),
                                       F.max("v").alias("_mx")).collect()
        stats = {tuple(r[k] for k in keys): (r["_n"], r["_mn"], r["_mx"]) for r in rows}
    out = _refine(stats, probs, list_limit, lambda active, linear: _joined_counts(long, keys, key_types, active, linear, buckets),
                  lambda listed: _joined_values(long, keys, key_types, listed))
    schema = T.StructType([T.StructField(k, t) for k, t in zip(keys, key_types)] +
                          [T.StructField("n", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))])
    return long.sparkSession.createDataFrame(out, schema)


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float], stats: dict, buckets: int = COLUMN_BUCKETS,
                     list_limit: int = LIST_LIMIT) -> dict[str, list[float]]:
    """Exact interpolated quantiles of whole columns; ``stats``: (n, min, max) of each.

    The same refinement, on the rows as they are: the few windows of a column are
    literals of one expression, so no row is joined, and a row makes one cell for each column.
    """
    values = {c: numeric_value(c, df) for c in columns}
    long = unpivot_values(df, list(dict.fromkeys(columns)), "double").withColumnRenamed("value", "v")
    types = [T.StringType()]

    def counts(active: dict, linear: bool) -> DataFrame:
        if not linear or not all(math.isfinite(b - a) for _, a, b in active.values()):
            return _joined_counts(long, ["column"], types, active, linear, buckets)

        def cell(wid, v, a, b):
            even = F.floor((v - F.lit(a)) / F.lit(b - a) * buckets).cast("long")
            return F.lit(wid * buckets) + F.least(even, F.lit(buckets - 1))

        cells = _cells(df, values, active, cell)
        return cells.groupBy("_id").agg(F.count(F.lit(1)).alias("_c"), F.min("v").alias("_lo"), F.max("v").alias("_hi")) \
            .select(F.expr(f"_id div {buckets}").alias("_wid"), F.expr(f"_id % {buckets}").alias("_k"), "_c", "_lo", "_hi")

    def listed(windows: dict) -> DataFrame:
        return _cells(df, values, windows, lambda wid, v, a, b: F.lit(wid)).withColumnRenamed("_id", "_wid") \
            .groupBy("_wid", "v").agg(F.count(F.lit(1)).alias("_c"))

    return {g: q for g, _, q in _refine({(c,): stats[c] for c in columns}, probs, list_limit, counts, listed)}


def _cells(df: DataFrame, values: dict, windows: dict, cell) -> DataFrame:
    """(_id, v): ``cell`` of every value that lies in a window of its column."""
    of_column: dict = {}
    for wid, ((c,), a, b) in windows.items():
        of_column.setdefault(c, []).append((wid, a, b))
    structs = []
    for c, found in of_column.items():
        v = values[c]
        choice = [F.when(v.between(F.lit(a), F.lit(b)), cell(wid, v, a, b).cast("long")) for wid, a, b in found]
        structs.append(F.struct(F.coalesce(*choice).alias("_id"), v.alias("v")))
    return df.select(F.inline(F.array(*structs))).where("_id IS NOT NULL")


def _joined_counts(long: DataFrame, keys: list[str], key_types: list, active: dict, linear: bool, buckets: int) -> DataFrame:
    """(_wid, _k, _c, _lo, _hi): rows, least and greatest value of every bucket of the windows."""
    inside = _in_windows(long, _bucket_frame(long.sparkSession, active, keys, key_types, linear), keys)
    bucket = _count_at_or_below(F.col("_points"), F.col("v"), 0, PATTERN_BUCKETS - 1).cast("long")
    if linear:
        even = F.floor((F.col("v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * buckets).cast("long")
        bucket = F.when(F.col("_points").isNull(), F.least(even, F.lit(buckets - 1))).otherwise(bucket)
    return inside.groupBy("_wid", bucket.alias("_k")).agg(F.count(F.lit(1)).alias("_c"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))


def _joined_values(long: DataFrame, keys: list[str], key_types: list, windows: dict) -> DataFrame:
    return _in_windows(long, _window_frame(long.sparkSession, windows, keys, key_types), keys) \
        .groupBy("_wid", "v").agg(F.count(F.lit(1)).alias("_c"))


def _refine(stats: dict, probs: list[float], list_limit: int, counts, listed_values) -> list[tuple]:
    """(*group, n, quantiles) of every group. ``counts(windows, linear)`` and
    ``listed_values(windows)`` give the buckets and the values of open windows."""
    info = {g: v for g, v in stats.items() if v[0]}
    groups = list(info)
    # targets: (group, rank) -> value ; open: target -> (window id, offset)
    values: dict = {}
    windows: dict = {}
    open_t: dict = {}
    next_wid = rounds = 0
    for g in groups:
        n, mn, mx = info[g]
        ranks = set()
        for p in probs:
            pos = p * (n - 1)
            ranks.update({int(math.floor(pos)), int(math.ceil(pos))})
        if mn == mx:
            for r in ranks:
                values[(g, r)] = mn
            continue
        windows[next_wid] = (g, mn, mx)
        for r in ranks:
            open_t[(g, r)] = (next_wid, 0)
        next_wid += 1
    while open_t:
        active = {wid: windows[wid] for wid in {w for w, _ in open_t.values()}}
        linear = rounds < LINEAR_ROUNDS
        rounds += 1
        hist: dict = {}
        for r in counts(active, linear).collect():
            hist.setdefault(r["_wid"], []).append((r["_k"], r["_c"], r["_lo"], r["_hi"]))
        for wid in hist:
            hist[wid].sort()
        refine, listing = {}, {}
        new_windows: dict = {}
        for t, (wid, off) in open_t.items():
            g, rank = t
            run = off
            for _, c, lo, hi in hist[wid]:
                if run + c > rank:
                    if lo == hi:
                        values[t] = lo
                    else:
                        wkey = (g, lo, hi)
                        if wkey not in new_windows:
                            new_windows[wkey] = next_wid
                            windows[next_wid] = (g, lo, hi)
                            next_wid += 1
                        (listing if c <= list_limit else refine)[t] = (new_windows[wkey], run)
                    break
                run += c
        if listing:
            lw = {wid: windows[wid] for wid in {w for w, _ in listing.values()}}
            listed: dict = {}
            for r in listed_values(lw).collect():
                listed.setdefault(r["_wid"], []).append((r["v"], r["_c"]))
            for t, (wid, off) in listing.items():
                run = off
                for v, c in sorted(listed[wid]):
                    if run + c > t[1]:
                        values[t] = v
                        break
                    run += c
        open_t = refine
    out = []
    for g in groups:
        n = info[g][0]
        qs = []
        for p in probs:
            pos = p * (n - 1)
            lo, hi = int(math.floor(pos)), int(math.ceil(pos))
            vlo, vhi = values[(g, lo)], values[(g, hi)]
            qs.append(vlo if (lo == hi or vlo == vhi) else (hi - pos) * vlo + (pos - lo) * vhi)
        out.append((*g, n, qs))
    return out


def small_groups(long: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of at most ``GROUP_ROWS`` rows, and those of larger ones (None: no such
    group). The larger groups are few, whatever the number of groups: their keys are broadcast."""
    large = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > GROUP_ROWS) \
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    rows = large.collect()
    if not rows:
        return long, None
    found = F.broadcast(long.sparkSession.createDataFrame(rows, large.schema))
    on = [long[k].eqNullSafe(found[f"_k{i}"]) for i, k in enumerate(keys)]
    return long.join(found, on, "left_anti"), long.join(found, on, "left_semi")


def with_quantiles(long: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Every row of ``long`` with its group's size ``n`` and quantiles ``q``: one shuffle by
    group, a group's rows sorted in one task (see :func:`small_groups`)."""
    group = Window.partitionBy(*keys)
    rows = long.withColumn("v", F.col("v") + F.lit(0.0))   # as groupBy does: -0.0 is 0.0
    rows = rows.withColumn("_i", F.row_number().over(group.orderBy("v")) - 1).withColumn("n", F.count(F.lit(1)).over(group))
    at = [[F.max(F.when(F.col("_i") == rank, F.col("v"))).over(group) for rank in pair] for pair in _ranks(probs)]
    rows = rows.withColumns({f"_v{i}{side}": v for i, pair in enumerate(at) for side, v in enumerate(pair)})
    return rows.withColumn("q", _interpolated(probs)).drop("_i", *[f"_v{i}{side}" for i in range(len(probs)) for side in (0, 1)])


def _ranks(probs: list[float]) -> list[tuple]:
    return [(F.floor(F.lit(float(p)) * (F.col("n") - 1)), F.ceil(F.lit(float(p)) * (F.col("n") - 1))) for p in probs]


def _interpolated(probs: list[float]):
    """The quantiles of a row with ``n`` and the two values ``_v<i>0``, ``_v<i>1`` around each."""
    out = []
    for i, (p, (lo, hi)) in enumerate(zip(probs, _ranks(probs), strict=True)):
        pos, v_lo, v_hi = F.lit(float(p)) * (F.col("n") - 1), F.col(f"_v{i}0"), F.col(f"_v{i}1")
        out.append(F.when((lo == hi) | (v_lo == v_hi), v_lo).otherwise((hi - pos) * v_lo + (pos - lo) * v_hi))
    return F.array(*out)


def grouped_quantiles(long: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``keys + [n, q]`` like :func:`exact_quantiles`, for any number of groups. No group of more
    than ``GROUP_ROWS`` rows is held by one task, reaches the driver or is broadcast."""
    small, large = small_groups(long, keys)
    out = with_quantiles(small, keys, probs).groupBy(*keys).agg(F.first("n").alias("n"), F.first("q").alias("q"))
    return out if large is None else out.unionByName(large_group_quantiles(large, keys, probs))


def large_group_quantiles(long: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``keys + [n, q]`` where a group may be larger than a task should sort.

    Values are counted per group (combined on the map side) and ranked by distributed
    prefix sums over the whole order of (group, value), which cut a large group into several
    blocks. The order statistics are the values whose run of ranks holds the wanted one.
    """
    counts = long.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("_c"))
    runs = prefix_before(counts, keys, ["v"], "_c", "_before")
    total = [f"_t{i}" for i in range(len(keys))]
    totals = counts.groupBy(*[F.col(k).alias(t) for k, t in zip(keys, total)]).agg(F.sum("_c").alias("n"))
    on = [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, total)]
    rows = runs.join(totals, on).drop(*total)
    holds = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c"))
    picked = rows.groupBy(*keys, "n").agg(*[F.max(F.when(holds(r), F.col("v"))).alias(f"_v{i}{side}")
                                            for i, pair in enumerate(_ranks(probs)) for side, r in enumerate(pair)])
    return picked.select(*keys, "n", _interpolated(probs).alias("q"))
