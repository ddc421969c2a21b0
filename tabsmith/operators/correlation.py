"""Correlation matrices (A13-A15, V5) as long tables ``(col_x, col_y, corr)``.

* Pearson: every pair in ONE aggregate of guarded co-moments (pairwise-complete rows).
* Spearman: Pearson over average ranks. Ranks come from the per-column value-count
  table with an exact distributed prefix sum (``prefix_before``): no window over a
  whole column, no row ids. Each column's ranks are joined back on its value (a
  skewed value is split by AQE's skew join, and the join is by value, so the rank
  table is at most the number of distinct values). With missing values that table has a rank
  for every partner column: each pair ranks its own complete rows.
* Kendall tau-b: Knight's formula ``S = n0 - n1 - n2 + n3 - 2 nd``. Tie totals are
  plain aggregates; the discordant count ``nd`` is the number of cell pairs ordered
  differently by the total orders (x, y) and (y, x), i.e. the inversions of the
  (y, x)-rank sequence in (x, y) order. They are counted by a distributed merge sort:
  a pandas pass inside bounded base blocks, then one pass of distributed prefix sums per
  four higher bits of the x-rank. No pair is ever materialised; memory per task is bounded.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.columns import col, numeric_columns, numeric_value
from tabsmith.functions.stats import pairwise_pearson
from tabsmith.session import materialized, spread
from tabsmith.operators.ranking import (
    ROWS_PER_BLOCK, prefix_before, prefixes_before, weighted_inversions,
)


AGGS_PER_PASS = 512   # keeps each aggregate's generated code small; more pairs -> more passes
PAIRS_PER_PASS = 6    # Kendall: cells a row makes in one pass
TILE = 12             # Spearman with missing values: a pass takes the pairs of two blocks of so many columns
BROADCAST_VALUES = 20_000   # and sends the ranks of a column with no more distinct values to every task
BITS_PER_PASS = 4     # Kendall: bits of the x-rank settled by one pass of prefix sums


def _pairs(columns: list[str], diagonal: bool = False) -> list[tuple[int, int]]:
    k = len(columns)
    return [(i, j) for i in range(k) for j in range(i if diagonal else i + 1, k)]


def pearson_matrix(df: DataFrame, columns: list[str] | None = None, complete: bool | None = None,
                   means: list[float] | None = None) -> DataFrame:
    """``(col_x, col_y, corr)`` for every pair ``x`` before ``y`` in column order.

    ``complete`` (checked with one cheap count when unknown) selects the null-free form:
    means first, then plain sums of centred products (one per pair and column) - the
    accurate two-pass form, codegen-friendly. Known column ``means`` (e.g. ``(n + 1) / 2``
    for average ranks) skip the first pass. With missing values each pair uses its own
    complete rows (guarded co-moments). At most ``AGGS_PER_PASS`` aggregates run per
    pass, so many columns mean more passes, never one giant generated aggregate. The
    result (one row per pair) is computed eagerly and returned as a small frame.
    """
    columns = columns if columns is not None else numeric_columns(df)
    pairs = _pairs(columns)
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_x string, col_y string, corr double")
    with materialized(df.select(*[col(c) for c in dict.fromkeys(columns)])) as d:
        return _pearson_rows(d, columns, pairs, complete, means)


def _pearson_rows(df: DataFrame, columns: list[str], pairs: list, complete: bool | None,
                  means: list[float] | None) -> DataFrame:
    vals = [numeric_value(c, df) for c in columns]
    if complete is None:
        complete = not any(df.schema[c].nullable for c in columns) or \
            df.agg(*[F.count_if(v.isNull()) for v in vals]).first() == tuple([0] * len(vals))
    if complete:
        # no missing values: two passes - means, then plain sums of centred products
        # (one per pair and one per column): accurate, and small enough for codegen
        if means is None:
            means = list(df.agg(*[F.avg(v) for v in vals]).first())   # one row of scalars
        d = [numeric_value(c, df) - F.lit(m).cast("double") for c, m in zip(columns, means)]
        terms = [(i, i) for i in range(len(columns))] + pairs
        got: dict = {}
        for start in range(0, len(terms), AGGS_PER_PASS):   # bounded aggregate width per pass
            chunk = terms[start:start + AGGS_PER_PASS]
            got.update(zip(chunk, df.agg(*[F.sum(d[i] * d[j]) for i, j in chunk]).first()))
        rows = []
        for i, j in pairs:
            sx, sy, sxy = got[(i, i)], got[(j, j)], got[(i, j)]
            ok = sx is not None and sy is not None and sx * sy > 0
            rows.append((columns[i], columns[j], sxy / math.sqrt(sx * sy) if ok else None))
        return df.sparkSession.createDataFrame(rows, "col_x string, col_y string, corr double")
    per_pass = max(1, AGGS_PER_PASS // 3)                     # three co-moments per pair
    rows = []
    for start in range(0, len(pairs), per_pass):
        chunk = pairs[start:start + per_pass]
        vals_row = df.agg(*[pairwise_pearson(vals[i], vals[j]) for i, j in chunk]).first()
        rows += [(columns[i], columns[j], v) for (i, j), v in zip(chunk, vals_row)]
    return df.sparkSession.createDataFrame(rows, "col_x string, col_y string, corr double")


def _average_ranks(values: DataFrame, rows_per_block: int) -> DataFrame:
    """``(column, value, rank)``: average rank of each distinct value within its column."""
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = prefix_before(counts, ["column"], ["value"], weight="cnt", out="before",
                           rows_per_block=rows_per_block)
    return ranked.select("column", "value",
                         (F.col("before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0)).alias("rank"))


def _rank_columns(df: DataFrame, columns: list[str], rows_per_block: int):
    """Replace each column by its average rank (complete rows assumed).

    Returns ``(ranked frame, rank table)``; the rank table (one row per distinct value
    and column) is persisted because every column's join reads it - the caller
    unpersists it once the result has been computed.
    """
    from pyspark import StorageLevel

    vals = df.select(*[numeric_value(c, df).alias(f"v{i}") for i, c in enumerate(columns)])
    long = vals.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(f"v{i}").alias("value")) for i in range(len(columns))
    ])))
    ranks = _average_ranks(long, rows_per_block).persist(StorageLevel.MEMORY_AND_DISK)
    out = vals
    for i in range(len(columns)):
        r_i = ranks.where(F.col("column") == i).select(F.col("value").alias(f"v{i}"), F.col("rank").alias(f"r{i}"))
        out = out.join(r_i, f"v{i}", "left")
    return out.select(*[F.col(f"r{i}") for i in range(len(columns))]), ranks


def spearman_matrix(df: DataFrame, columns: list[str] | None = None,
                    rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Spearman rho = Pearson over average ranks, pairwise-complete like pandas.

    Without missing values every column is ranked once; with missing values each pair
    is ranked on its own complete rows (pandas' rule).
    """
    columns = columns if columns is not None else numeric_columns(df)
    pairs = _pairs(columns)
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "col_x string, col_y string, corr double")
    vals = [numeric_value(c, df) for c in columns]
    nulls = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count_if(v.isNull()).alias(f"z{i}") for i, v in enumerate(vals)]).first()
    schema = "col_x string, col_y string, corr double"
    if all(nulls[f"z{i}"] == 0 for i in range(len(columns))):
        ranked, table = _rank_columns(df, columns, rows_per_block)
        try:
            # average ranks of n complete rows always have mean (n + 1) / 2: one pass suffices
            centre = (nulls["_n"] + 1) / 2.0
            rows = [tuple(r) for r in pearson_matrix(ranked.toDF(*columns), columns, complete=True,
                                                     means=[centre] * len(columns)).collect()]
        finally:
            table.unpersist()
        return spark.createDataFrame(rows, schema)
    return _spearman_by_pair(df, columns, pairs, rows_per_block)


def _complete_pairs(df: DataFrame, columns: list[str], pairs: list) -> DataFrame:
    """(pair, x, y): the complete rows of every pair of columns."""
    vals = [numeric_value(c, df) for c in columns]
    entries = F.array(*[
        F.when(vals[i].isNotNull() & vals[j].isNotNull(),
               F.struct(F.lit(n).alias("pair"), vals[i].alias("x"), vals[j].alias("y")))
        for n, (i, j) in enumerate(pairs)
    ])
    return df.select(F.inline(F.filter(entries, lambda e: e.isNotNull())))


def _spearman_by_pair(df: DataFrame, columns: list[str], pairs: list, rows_per_block: int) -> DataFrame:
    """Rank correlation with each pair ranked on its own complete rows. A pass takes the pairs
    of two blocks of ``TILE`` columns, so up to ``TILE`` columns need one pass."""
    tiles: dict = {}
    for i, j in pairs:
        tiles.setdefault((i // TILE, j // TILE), []).append((i, j))
    corr: dict = {}
    for tile in tiles.values():
        corr.update(_spearman_tile(df, columns, tile, rows_per_block))
    rows = [(columns[i], columns[j], corr.get((i, j))) for i, j in pairs]
    return df.sparkSession.createDataFrame(rows, "col_x string, col_y string, corr double")


def _spearman_tile(df: DataFrame, columns: list[str], pairs: list, rows_per_block: int) -> dict:
    """One table for all columns: how often each value occurs in the complete rows of its
    column with every other one, and from that the value's rank in each pair. Every column's
    ranks are joined back to the rows on its value; a row is never copied for its pairs."""
    from pyspark import StorageLevel

    used = sorted({c for pair in pairs for c in pair})
    partners = {i: [a if b == i else b for a, b in pairs if i in (a, b)] for i in used}
    vals = df.select(*[numeric_value(columns[i], df).alias(f"v{i}") for i in used])
    entries = F.array(*[
        F.when(F.col(f"v{i}").isNotNull(), F.struct(F.lit(i).alias("column"), F.col(f"v{i}").alias("value"),
                                                    *[F.col(f"v{j}").isNotNull().alias(f"p{j}") for j in used])) for i in used])
    counts = vals.select(F.inline(F.filter(entries, lambda e: e.isNotNull()))).groupBy("column", "value") \
        .agg(*[F.count_if(F.col(f"p{j}")).alias(f"n{j}") for j in used])
    before = prefixes_before(counts, ["column"], ["value"], {f"b{j}": F.col(f"n{j}") for j in used}, rows_per_block)
    ranks = before.select("column", "value", *[f"n{j}" for j in used],
                          *[(F.col(f"b{j}") + (F.col(f"n{j}") + 1) / 2.0).alias(f"r{j}") for j in used]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        of = {r["column"]: r for r in ranks.groupBy("column").agg(
            F.count(F.lit(1)).alias("values"), *[F.sum(f"n{j}").alias(f"all{j}") for j in used]).collect()}   # one row a column
        if len(of) < len(used):                            # columns without any value have no pair
            pairs = [p for p in pairs if p[0] in of and p[1] in of]
        off = {(i, j): F.col(f"r{j}") - (of[i][f"all{j}"] + 1) / 2.0 for i in of for j in partners[i] if j in of}
        if not pairs:
            return {}
        squares = ranks.agg(*[F.sum(F.when(F.col("column") == i, F.col(f"n{j}") * d * d)).alias(f"s{i}_{j}") for (i, j), d in off.items()]).first()
        out = vals
        for i in sorted(of, key=lambda i: -of[i]["values"]):   # the joins by shuffle first, while rows are narrow
            own = ranks.where(F.col("column") == i).select(F.col("value").alias(f"v{i}"), *[off[i, j].alias(f"d{i}_{j}") for j in partners[i] if j in of])
            out = out.join(F.broadcast(own) if of[i]["values"] <= BROADCAST_VALUES else own, f"v{i}", "left")
        products = out.agg(*[F.sum(F.col(f"d{i}_{j}") * F.col(f"d{j}_{i}")).alias(f"s{i}_{j}") for i, j in pairs]).first()
    finally:
        ranks.unpersist()
    corr = {}
    for i, j in pairs:
        xx, yy, xy = squares[f"s{i}_{j}"], squares[f"s{j}_{i}"], products[f"s{i}_{j}"]
        corr[i, j] = xy / math.sqrt(xx * yy) if xy is not None and xx > 0 and yy > 0 else None
    return corr


# ---------------------------------------------------------------- Kendall tau-b

def _base_inversions(key, pdf):
    """One base block of one pair: cells in x-order (``rx``), inversions of their y-order."""
    pdf = pdf.sort_values("rx", kind="mergesort")
    inv = weighted_inversions(pdf["ry"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame({"pair": [int(key[0])], "inv": [str(inv)]})


def _discordant(cells: DataFrame, max_cells: int, rows_per_block: int) -> dict[int, int]:
    """Weighted count of cell pairs with ``x_a < x_b`` and ``y_a > y_b``, per pair.

    Distributed merge-sort inversion count: exact ranks ``rx`` (order x, y) and ``ry``
    (order y, x); pairs inside a base block of ``2^L0 <= rows_per_block`` consecutive
    ``rx`` are counted by one grouped pandas pass; pairs that first separate in a later
    digit of ``rx`` (``BITS_PER_PASS`` bits) are counted per digit place as ``n_b * (weight
    above ry_b with a smaller digit)``, one pass of prefix sums for all values of the digit.
    Per-task memory is bounded by ``rows_per_block``.
    """
    from pyspark import StorageLevel

    ranked = prefix_before(cells, ["pair"], ["x", "y"], None, "rx", rows_per_block)
    ranked = prefix_before(ranked, ["pair"], ["y", "x"], None, "ry", rows_per_block) \
        .select("pair", "rx", "ry", "n").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base_bits = max(0, int(math.floor(math.log2(max(1, rows_per_block)))))
        nd: dict[int, int] = {}
        local = ranked.groupBy("pair", F.shiftright("rx", base_bits).alias("_g")) \
            .applyInPandas(_base_inversions, "pair long, inv string")
        for r in local.collect():
            nd[r["pair"]] = nd.get(r["pair"], 0) + int(r["inv"])
        top = max(1, int(math.ceil(math.log2(max(2, max_cells)))))
        for level in range(base_bits, top, BITS_PER_PASS):
            bits = min(BITS_PER_PASS, top - level)
            t = ranked.select("pair", F.shiftright("rx", level + bits).alias("_p"), "ry", "n",
                              F.shiftright("rx", level).bitwiseAND(F.lit((1 << bits) - 1)).alias("_s"))
            # for every digit d: the weight of the cells with a smaller digit, in all and before this one
            lower = {d: F.when(F.col("_s") < d, F.col("n")).otherwise(F.lit(0)) for d in range(1, 1 << bits)}
            totals = t.groupBy("pair", "_p").agg(*[F.sum(w).alias(f"_t{d}") for d, w in lower.items()])
            below = prefixes_before(t, ["pair", "_p"], ["ry"], {f"_b{d}": w for d, w in lower.items()}, rows_per_block)
            above = F.coalesce(*[F.when(F.col("_s") == d, F.col(f"_t{d}") - F.col(f"_b{d}")) for d in lower])
            right = below.where(F.col("_s") > 0).join(totals, ["pair", "_p"])
            contrib = F.col("n").cast("decimal(20,0)") * above.cast("decimal(20,0)")
            for r in right.groupBy("pair").agg(F.sum(contrib).cast("string").alias("c")).collect():
                nd[r["pair"]] = nd.get(r["pair"], 0) + int(r["c"])
        return nd
    finally:
        ranked.unpersist()


def kendall_matrix(df: DataFrame, columns: list[str] | None = None, rows_per_block: int = ROWS_PER_BLOCK,
                   pairs_per_pass: int = PAIRS_PER_PASS) -> DataFrame:
    """``(col_x, col_y, corr)`` Kendall tau-b for every pair (pairwise-complete).

    Each pass takes ``pairs_per_pass`` pairs, so a row grows into that many cells at most
    before they are counted. The pairs of a pass share one cell table ``(pair, x, y, n)``,
    one aggregate for the tie totals and the discordant count of :func:`_discordant`.
    Results are a few scalars per pair, assembled into a small frame.
    """
    columns = columns if columns is not None else numeric_columns(df)
    pairs = _pairs(columns)
    spark = df.sparkSession
    schema = "col_x string, col_y string, corr double"
    if not pairs:
        return spark.createDataFrame([], schema)
    df = spread(df.select(*[col(c) for c in dict.fromkeys(columns)]))
    rows = []
    for start in range(0, len(pairs), pairs_per_pass):
        rows += _kendall_rows(df, columns, pairs[start:start + pairs_per_pass], rows_per_block)
    return spark.createDataFrame(rows, schema)


def _kendall_rows(df: DataFrame, columns: list[str], pairs: list, rows_per_block: int) -> list[tuple]:
    long = _complete_pairs(df, columns, pairs)
    cells = long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        base = {r["pair"]: r for r in cells.groupBy("pair").agg(
            F.count(F.lit(1)).alias("ncells"), F.sum("n").alias("N"),
            F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("n3")).collect()}
        margins = cells.select("pair", F.inline(F.array(
            F.struct(F.lit(0).alias("axis"), F.col("x").alias("v"), F.col("n").alias("n")),
            F.struct(F.lit(1).alias("axis"), F.col("y").alias("v"), F.col("n").alias("n")))))
        ties = {(r["pair"], r["axis"]): int(r["t"]) for r in margins.groupBy("pair", "axis", "v")
                .agg(F.sum("n").alias("m")).groupBy("pair", "axis")
                .agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("t")).collect()}
        max_cells = max(r["ncells"] for r in base.values()) if base else 0
        nd = _discordant(cells, max_cells, rows_per_block) if base else {}
    finally:
        cells.unpersist()
    rows = []
    for p, (i, j) in enumerate(pairs):
        corr = None
        if p in base:
            total = int(base[p]["N"])
            n0 = total * (total - 1) // 2
            n1, n2, n3 = ties.get((p, 0), 0), ties.get((p, 1), 0), int(base[p]["n3"])
            den = (n0 - n1) * (n0 - n2)
            if den > 0:
                corr = (n0 - n1 - n2 + n3 - 2 * nd.get(p, 0)) / math.sqrt(den)
        rows.append((columns[i], columns[j], corr))
    return rows


def kendall_pair(df: DataFrame, x: str, y: str, rows_per_block: int = ROWS_PER_BLOCK) -> float | None:
    """Exact Kendall tau-b of two numeric columns over their complete rows."""
    return kendall_matrix(df, [x, y], rows_per_block).first()["corr"]


def correlation_matrix(df: DataFrame, method: str = "pearson", columns: list[str] | None = None) -> DataFrame:
    if method == "pearson":
        return pearson_matrix(df, columns)
    if method == "spearman":
        return spearman_matrix(df, columns)
    if method == "kendall":
        return kendall_matrix(df, columns)
    raise ValueError(f"unknown correlation method {method!r}")


def heatmap_cells(df: DataFrame, method: str = "pearson", columns: list[str] | None = None) -> DataFrame:
    """V5: the full symmetric matrix with its diagonal, as long cells.

    The diagonal is 1 for a column with variance, null (pandas NaN) otherwise.
    """
    columns = columns if columns is not None else numeric_columns(df)
    upper = correlation_matrix(df, method, columns)
    mirrored = upper.select(F.col("col_y").alias("col_x"), F.col("col_x").alias("col_y"), "corr")
    vals = [numeric_value(c, df) for c in columns]
    diag_row = df.agg(*[F.when(F.stddev_pop(v) > 0, F.lit(1.0)).alias(f"d{i}") for i, v in enumerate(vals)])
    diag = diag_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col_x"), F.lit(c).alias("col_y"), F.col(f"d{i}").alias("corr"))
        for i, c in enumerate(columns)
    ])))
    return upper.unionByName(mirrored).unionByName(diag)
