"""Order-statistics building blocks that never put one group in one task.

``range_blocks`` cuts a total order into ~equal blocks from boundaries taken from a
small seeded sample (sorted by Spark itself, collected as at most a few thousand
literals), and assigns each row its block with a balanced CASE tree (log2(P)
comparisons, codegen'd). ``prefix_before`` then computes, for every row, the total
weight of the rows before it in its partition key: local window sums per block plus
per-block offsets from a P-row table. A key that holds a third of the rows is spread
over a third of the blocks, because blocks cut the *ordering*, not the key.

Beyond ``MAX_BLOCKS`` blocks (about 4x10^9 rows at the default block size) the cut has
two levels: coarse blocks from the CASE tree, then inside each coarse block the fine
split points of a larger seeded sample, picked on executors (ranked within each coarse
block), written once and joined as one sorted array per coarse block (at most ``MAX_BLOCKS`` rows).
A row's fine block is the number of its coarse block's split points at or below its key,
found by an unrolled binary search (log2 lookups, codegen'd). Blocks stay near
``rows_per_block`` up to ``MAX_BLOCKS**2`` blocks, and the driver never holds more than
the coarse sample.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.columns import col
from tabsmith.session import cut_lineage

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 4096          # bounds the CASE tree (depth 12) and the collected boundaries
_SAMPLES_PER_BLOCK = 20


def _literal(v):
    return F.lit(v)


def _less_than(key_cols: list[Column], bound: tuple) -> Column:
    """Lexicographic ``key < bound`` over several columns, nulls first as Spark sorts."""
    expr = F.lit(False)
    for key, value in reversed(list(zip(key_cols, bound, strict=True))):
        less = F.lit(False) if value is None else F.coalesce(key < _literal(value), F.lit(True))
        expr = less | (key.eqNullSafe(_literal(value)) & expr)
    return expr


def _block_tree(key_cols: list[Column], bounds: list[tuple], lo: int, hi: int) -> Column:
    """Block id in [lo, hi]: number of bounds <= key, by binary search."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2  # bounds[mid-1] separates block mid-1 from block mid
    return F.when(_less_than(key_cols, bounds[mid - 1]), _block_tree(key_cols, bounds, lo, mid - 1)) \
        .otherwise(_block_tree(key_cols, bounds, mid, hi))


def block_count(n_rows: int, rows_per_block: int = ROWS_PER_BLOCK, max_blocks: int = MAX_BLOCKS ** 2) -> int:
    """Blocks of about ``rows_per_block`` rows, at most ``max_blocks`` (larger blocks
    beyond that: results stay exact, per-block sorts spill)."""
    return max(1, min(max_blocks, math.ceil(n_rows / rows_per_block)))


def sample_bounds(df: DataFrame, order_cols: list[str], blocks: int, n_rows: int, seed: int = 17) -> list[tuple]:
    """``blocks - 1`` split points of the order, from a seeded sample sorted by Spark."""
    if blocks <= 1 or n_rows == 0:
        return []
    want = blocks * _SAMPLES_PER_BLOCK
    frac = min(1.0, want / n_rows * 1.5)
    sample = df.select(*order_cols).sample(False, frac, seed).orderBy(*order_cols).collect()
    if not sample:
        return []
    picks = []
    for b in range(1, blocks):
        row = sample[min(len(sample) - 1, (b * len(sample)) // blocks)]
        picks.append(tuple(row))
    # distinct, still in Spark's order
    out = []
    for p in picks:
        if not out or p != out[-1]:
            out.append(p)
    return out


def range_blocks(df: DataFrame, order_cols: list[str], bounds: list[tuple], name: str = "block") -> DataFrame:
    keys = [F.col(c) for c in order_cols]
    if not bounds:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, _block_tree(keys, bounds, 0, len(bounds)))


def _count_at_or_below(arr: Column, key: Column, lo: int, hi: int) -> Column:
    """Number of elements <= ``key`` in the sorted ``arr`` (at most ``hi`` elements), by an
    unrolled binary search over literal positions; a missing position counts as +inf."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2
    le = F.coalesce(F.try_element_at(arr, F.lit(mid)) <= key, F.lit(False))
    return F.when(le, _count_at_or_below(arr, key, mid, hi)).otherwise(_count_at_or_below(arr, key, lo, mid - 1))


def two_level_blocks(df: DataFrame, order_cols: list[str], blocks: int, n_rows: int, coarse_max: int = MAX_BLOCKS,
                     seed: int = 17, name: str = "block") -> DataFrame:
    """Add ``name`` = block id (long) for ``blocks`` ordered blocks, with the coarse CASE
    tree capped at ``coarse_max`` and fine split points chosen inside each coarse block."""
    coarse = max(1, min(coarse_max, blocks))
    fine = max(1, math.ceil(blocks / coarse))
    coarse_bounds = sample_bounds(df, order_cols, coarse, n_rows, seed)
    if fine == 1:
        return range_blocks(df, order_cols, coarse_bounds, name).withColumn(name, F.col(name).cast("long"))
    key = F.struct(*[F.col(c) for c in order_cols])
    frac = min(1.0, blocks * _SAMPLES_PER_BLOCK / max(1, n_rows) * 1.5)
    smp = range_blocks(df.select(*order_cols).sample(False, frac, seed + 1), order_cols, coarse_bounds, "_c")
    smp = smp.withColumn("_i", F.row_number().over(Window.partitionBy("_c").orderBy(*order_cols)) - 1) \
        .withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy("_c")))
    # a sample row is a split point when it starts a new one of ``fine`` equal runs
    seg = F.floor(F.col("_i") * F.lit(fine) / F.col("_m"))
    prev = F.floor((F.col("_i") - 1) * F.lit(fine) / F.col("_m"))
    # written once: a recomputed task must see the same points, whatever order its rows came in
    points = cut_lineage(smp.where((F.col("_i") > 0) & (seg > prev))
                         .groupBy("_c").agg(F.array_sort(F.collect_list(key)).alias("_fb")))
    # one row per coarse block (<= coarse_max rows), each with fewer than ``fine`` points
    tagged = range_blocks(df, order_cols, coarse_bounds, "_c").join(points, "_c", "left")
    fine_id = F.when(F.col("_fb").isNull(), F.lit(0)).otherwise(_count_at_or_below(F.col("_fb"), key, 0, fine - 1))
    return tagged.withColumn(name, F.col("_c").cast("long") * F.lit(fine) + fine_id.cast("long")) \
        .drop("_c", "_fb")


def prefix_before(df: DataFrame, part_cols: list[str], order_cols: list[str], weight: str | None = None,
                  out: str = "before", rows_per_block: int = ROWS_PER_BLOCK, seed: int = 17,
                  max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 if None) over rows of the same ``part_cols``
    that sort strictly before this row by ``order_cols`` (rows equal on the order
    columns are ordered arbitrarily but consistently: pass a unique order)."""
    return prefixes_before(df, part_cols, order_cols, {out: F.col(weight) if weight else F.lit(1)}, rows_per_block, seed, max_blocks)


def prefixes_before(df: DataFrame, part_cols: list[str], order_cols: list[str], weights: dict[str, Column],
                    rows_per_block: int = ROWS_PER_BLOCK, seed: int = 17, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """:func:`prefix_before` for several weights (output name -> weight) in one pass."""
    n = df.count()
    blocks = block_count(n, rows_per_block, max_blocks * max_blocks)
    if blocks == 1:
        # the whole input fits one block: a plain window per part is exact and bounded
        w1 = Window.partitionBy(*part_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({out: F.coalesce(F.sum(w.cast("long")).over(w1), F.lit(0)).cast("long") for out, w in weights.items()})
    # one text per part, never null: nulls are a part of their own
    mark = [F.coalesce(col(c).cast("string"), F.lit("\u0001")) for c in part_cols]
    df = df.withColumn("_part", F.concat_ws("\u0002", *mark) if mark else F.lit(""))
    if blocks <= max_blocks:
        bounds = sample_bounds(df, ["_part", *order_cols], blocks, n, seed)
        tagged = range_blocks(df, ["_part", *order_cols], bounds, "_blk")
    else:
        tagged = two_level_blocks(df, ["_part", *order_cols], blocks, n, max_blocks, seed, "_blk")
    names = list(weights)
    tagged = tagged.withColumns({f"_w{i}": weights[o].cast("long") for i, o in enumerate(names)})
    totals = tagged.groupBy("_blk", "_part").agg(*[F.sum(f"_w{i}").alias(f"_tot{i}") for i in range(len(names))])
    wo = Window.partitionBy("_part").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_blk", "_part", *[F.coalesce(F.sum(f"_tot{i}").over(wo), F.lit(0)).alias(f"_off{i}") for i in range(len(names))])
    # offsets has at most (blocks x parts) rows; the rows are already dealt by (_blk, _part)
    # for the window, so the join moves only the offsets
    wl = Window.partitionBy("_blk", "_part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumns({f"_loc{i}": F.coalesce(F.sum(f"_w{i}").over(wl), F.lit(0)) for i in range(len(names))})
    joined = local.join(offsets, ["_blk", "_part"], "inner")
    done = joined.withColumns({o: F.col(f"_off{i}") + F.col(f"_loc{i}") for i, o in enumerate(names)})
    return done.drop("_blk", "_part", *[f"{p}{i}" for i in range(len(names)) for p in ("_w", "_off", "_loc")])


def weighted_inversions(values: np.ndarray, weights: np.ndarray) -> int:
    """Sum of ``w_i * w_j`` over index pairs ``i < j`` with ``values[i] > values[j]``.

    Bottom-up merge counting, vectorised per level: O(n log^2 n) numpy work, exact
    integer result (Python int, no overflow).
    """
    n = len(values)
    if n < 2:
        return 0
    _, r = np.unique(values, return_inverse=True)
    r = r.astype(np.int64).ravel()
    w = np.asarray(weights, dtype=np.int64)
    m = int(r.max()) + 1
    pos = np.arange(n, dtype=np.int64)
    total = 0
    width = 1
    while width < n:
        block = pos // (2 * width)
        is_right = (pos // width) % 2 == 1
        left = ~is_right
        lkey = block[left] * m + r[left]
        order = np.argsort(lkey, kind="stable")
        lkey_sorted = lkey[order]
        lw_cum = np.concatenate(([0], np.cumsum(w[left][order])))
        rb = block[is_right]
        rkey = rb * m + r[is_right]
        # left weight in the same block with value > r_j
        upper = np.searchsorted(lkey_sorted, rb * m + (m - 1), side="right")
        lower = np.searchsorted(lkey_sorted, rkey, side="right")
        above = lw_cum[upper] - lw_cum[lower]
        rw = w[is_right]
        if above.size:
            if int(above.max()) * int(rw.max()) < 2 ** 62:
                prod = above * rw  # each term fits; sum the high and low halves exactly
                total += (int(np.sum(prod >> 31)) << 31) + int(np.sum(prod & ((1 << 31) - 1)))
            else:
                total += sum(int(a) * int(b) for a, b in zip(above, rw))
        width *= 2
    return total
