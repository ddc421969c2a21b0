"""op7: exact top-k inner products by pivot-table elimination.

Vectors become integers floor(1024 x). For a query q and a candidate x the inner product
is (|q|^2 + |x|^2 - d(q, x)^2) / 2, and every pivot p bounds the distance from below by
|d(q, p) - d(x, p)|. The maximum over many pivots gives an upper bound of the score.
Distances from candidates to pivots are computed once and kept as a table (the pivot
table); a search orders the candidates of a block by their bound and evaluates exact
integer products until the k-th best score found exceeds every bound left.

Queries go out in blocks of bounded bytes; each block scans the pivot table once. A task
carries the best k of every query from batch to batch and returns them at its end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import shared_table, table

K = 10
QUERY_STEP = 100
SCALE = 1024
PIVOTS = 48
PIVOT_SAMPLE = 2048        # rows that pivots are chosen from, by hash
QUERY_BLOCK_BYTES = 16 << 20
EVALUATE = 512             # candidates evaluated at a time


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) without rows that take no part: a null vector or id, a null
    or non-finite component."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("v")))


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, matrix of raw components) for each dimension of a list column."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values).astype(np.float64)
    lengths = np.diff(offsets)
    return [(int(d), rows := np.flatnonzero(lengths == d),
             values[(offsets[:-1][rows, None] + np.arange(d)).astype(np.int64)]) for d in np.unique(lengths)]


class Scaled:
    """Vectors as integers floor(SCALE x): as doubles (for bounds), as 64-bit integers where
    their products are sure to fit, else as Python integers."""

    def __init__(self, raw: np.ndarray):
        self.raw = raw
        with np.errstate(over="ignore"):
            self.real = np.floor(raw * SCALE)              # exact below 2^1013: SCALE is a power of two
        self.most = float(np.abs(self.real).max(initial=0.0))
        self.whole = self.real.astype(np.int64) if self.most < 2.0 ** 62 else None
        self.square = (self.real * self.real).sum(axis=1)

    def integers(self, rows) -> np.ndarray:
        # from 2^53 on a double is a whole number, whose multiple may pass the doubles
        return np.array([[int(c) * SCALE if abs(c) >= 2.0 ** 53 else math.floor(c * SCALE) for c in r] for r in self.raw[rows]],
                        dtype=object).reshape(len(rows), self.raw.shape[1])

    def products(self, rows, other: Scaled, at: int) -> np.ndarray:
        """Exact inner products of ``rows`` with row ``at`` of ``other``."""
        if self.whole is not None and other.whole is not None and \
                self.raw.shape[1] * self.most * float(np.abs(other.real[at]).max(initial=0.0)) < 2.0 ** 62:
            return self.whole[rows] @ other.whole[at]
        found = [int(sum(a * b for a, b in zip(x, other.integers([at])[0], strict=True))) for x in self.integers(rows)]
        if any(abs(f) >= 1 << 63 for f in found):
            raise OverflowError("a score does not fit a 64-bit integer")
        return np.array(found, np.int64)


def choose_pivots(sample: dict[int, np.ndarray], count: int) -> dict[int, np.ndarray]:
    """Per dimension: the sample row farthest from the pivots chosen so far, again and again."""
    out = {}
    for d, rows in sample.items():
        x = rows.astype(np.float64)
        picked = [0]
        far = np.full(len(x), np.inf)
        for _ in range(min(count, len(x)) - 1):
            far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(axis=1))
            picked.append(int(far.argmax()))
        out[d] = x[picked]
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
        return np.sqrt(np.maximum(np.nan_to_num(square, nan=np.inf), 0.0))


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``to_pivots``: the distances of each vector to the pivots of its dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = [None] * batch.num_rows
            for d, at, raw in _matrix(batch.column("v")):
                x = Scaled(raw).real
                for i, row in zip(at, _distances(x, pivots[d]) if d in pivots else np.zeros((len(x), 0)), strict=True):
                    found[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(found, pa.list_(pa.float64()))],
                names=["vec_id", "v", "to_pivots"])

    return rows.mapInArrow(add, "vec_id long, v array<double>, to_pivots array<double>")


def _search(q_id, q: Scaled, at: int, q_to, ids, x: Scaled, x_to, k, best_id, best, known: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The best k of a block and of those found before (``best_id``, ``best``) for one query,
    and the number of candidates evaluated. ``known``: a score that at least k candidates
    elsewhere reach (-inf if none)."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = np.abs(x_to - q_to).max(axis=1) if x_to.shape[1] else np.zeros(len(ids))
        gap = np.maximum(0.0, np.nan_to_num(gap, nan=0.0, posinf=0.0) * (1 - 1e-9) - 1e-6)  # rounding never lifts a lower bound
        both = q.square[at] + x.square
        bound = np.nan_to_num((both - gap * gap) / 2 + 1e-9 * both + 1e-6, nan=np.inf)
    least = max(known, best[k - 1] if len(best) >= k else -np.inf)
    order = np.flatnonzero(bound >= least)                 # most blocks end here
    order = order[np.argsort(-bound[order], kind="stable")]
    seen = 0
    for a in range(0, len(order), EVALUATE):
        part = order[a:a + EVALUATE]
        if bound[part[0]] < max(known, best[k - 1] if len(best) >= k else -np.inf):
            break
        part = part[ids[part] != q_id]
        seen += len(part)
        best_id = np.concatenate((best_id, ids[part]))
        best = np.concatenate((best, x.products(part, q, at)))
        top = np.lexsort((best_id, -best))[:k]
        best_id, best = best_id[top], best[top]
    return best_id, best, seen


def top_k(vectors: DataFrame, is_query, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that ``is_query`` accepts, its k best
    other rows by integer inner product, ties to the smaller vec_id.

    Vectors that take no part are neither queries nor candidates; only vectors of equal
    length are compared. Components of any finite size count exactly; a score that does not
    fit a 64-bit integer is an error. Very long vectors and clashing column names need
    nothing special (only vec_id and embedding are read). A repeated vec_id is one query (its first vector in value order)
    against all rows with another id; each of its rows is a candidate of other queries.
    Fewer than k candidates give fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    # bounded: the PIVOT_SAMPLE rows with the least hash
    picked = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOT_SAMPLE).toArrow()
    drawn: dict[int, list] = {}
    for batch in picked.to_batches():
        ids = batch.column("vec_id").to_numpy()
        for d, at, x in _matrix(batch.column("v")):
            drawn.setdefault(d, []).append((ids[at], x))
    sample = {d: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for d, parts in drawn.items()}
    sample = {d: (ids, Scaled(x)) for d, (ids, x) in sample.items()}
    points = choose_pivots({d: x.real for d, (_, x) in sample.items()}, pivots)
    index = shared_table(pivot_table(rows, points), "pivot-table", spark)

    one = Window.partitionBy("vec_id").orderBy("v")
    queries = index.where(is_query).withColumn("nth", F.row_number().over(one)).where("nth = 1").drop("nth")
    stats = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-stats["n"] * ((stats["d"] or 0) + pivots + 2) * 8 // QUERY_BLOCK_BYTES))
    parts = []
    for block in range(blocks):  # each block's size is bounded by QUERY_BLOCK_BYTES, about
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        sent: dict[int, list] = {}
        for batch in own.to_batches():
            ids = batch.column("vec_id").to_numpy()
            to = batch.column("to_pivots")
            for d, at, x in _matrix(batch.column("v")):
                sent.setdefault(d, []).append((ids[at], x, np.array([to[int(i)].as_py() for i in at]).reshape(len(at), -1)))
        sent = {d: tuple(np.concatenate(x) for x in zip(*parts_of_d, strict=True)) for d, parts_of_d in sent.items()}
        known = {}
        for d, (ids, q, _) in sent.items():  # scores within the sample: a first threshold
            known[d] = np.full(len(q), -np.inf)
            own = Scaled(q)
            if d in sample and len(sample[d][0]) >= k and max(own.most, sample[d][1].most) ** 2 * d < 2.0 ** 62:
                scores = np.where(sample[d][0] == ids[:, None], np.iinfo(np.int64).min, own.whole @ sample[d][1].whole.T)
                known[d] = np.partition(scores, -k, axis=1)[:, -k].astype(np.float64)
        shared = spark.sparkContext.broadcast((sent, known))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sent, known = shared.value
            queries = {d: Scaled(q) for d, (_, q, _) in sent.items()}
            none = np.zeros(0, np.int64)
            held = {d: [(none, none)] * len(ids) for d, (ids, _, _) in sent.items()}   # carried from batch to batch
            for batch in batches:
                all_ids, to = batch.column("vec_id").to_numpy(), batch.column("to_pivots")
                to_values, to_offsets = np.asarray(to.values), np.asarray(to.offsets)
                for d, at, raw in _matrix(batch.column("v")):
                    if d not in sent:
                        continue
                    ids, x = all_ids[at], Scaled(raw)
                    width = int(to_offsets[at[0] + 1] - to_offsets[at[0]])
                    x_to = to_values[(to_offsets[at][:, None] + np.arange(width)).astype(np.int64)]
                    for i, (q_id, q_to, least) in enumerate(zip(sent[d][0], sent[d][2], known[d], strict=True)):
                        held[d][i] = _search(q_id, queries[d], i, q_to, ids, x, x_to, k, *held[d][i], least)[:2]
            for d, best in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(sent[d][0], [len(b[0]) for b in best]).astype(np.int64)),
                     *[pa.array(np.concatenate([b[i] for b in best]).astype(np.int64)) for i in (0, 1)]],
                    names=["query_id", "vec_id", "score"])

        parts.append(index.mapInArrow(search, "query_id long, vec_id long, score long"))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(QUERY_STEP)) == 0)


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 10
"""
