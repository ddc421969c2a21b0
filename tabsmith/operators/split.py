"""Exact, reproducible, stratified train/test split and folds.

Order: ``h = md5(concat_ws('|', seed, key...))``; with no key, all columns. The test
set of class ``c`` is its ``test_c`` rows with the smallest ``h``; sizes follow the
reference exactly (``n_test = ceil(n * test_size)``, per-class train sizes by largest
remainder, ties by class value). Membership depends on content, not on row order or
partitioning.

At scale the split never shuffles the table: for each class we only need the
order statistic ``T_c`` = the smallest ``h`` that stays in train. The hash deals rows evenly,
so ``T_c`` lies close to the class's share of test rows: one scan counts the rows before a
window of ``_SIGMAS`` standard deviations around that place and lists the window's hashes
(some ten roots of the number of rows). Where the rank turns out to lie elsewhere (keys that
repeat often) or the window would be long, ``T_c`` is found by
counting rows per 4-hex-digit prefix of ``h`` (at most 65,536 counts per class, map-side
aggregated and summed up on executors), descending into the one bucket that holds the
rank, until the bucket is small enough for whole hashes. Each level is one filtered
scan; two levels cover 10^12 rows. Only one row per class and level reaches the driver.
Then ``test = h < T_c`` is a per-row comparison against a table with one row per class.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import col
from tabsmith.operators.ranking import prefix_before
from tabsmith.session import cut_lineage

_PREFIX = 4              # hex digits per refinement level
_HASH_DIGITS = 32
_LIST_LIMIT = 65_536     # buckets this small are resolved to whole hashes at once
_SIGMAS = 6              # half the width of the window in which the hash of a rank is looked for
_BUCKET_ROWS = 100_000   # folds: rows of a bucket at most, on average
_FULL_BUCKET = 1_000_000 # folds: a larger bucket holds a repeated key
_TIE_BLOCKS = 256        # coarse blocks where all columns order the rows (two levels beyond)
_BROADCAST_ROWS = 50_000  # class tables up to this size are broadcast
_NULL_MARK = "\u0001"
_NESTED = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


def order_hash(df: DataFrame, key: list[str] | None, seed: int) -> Column:
    """The split order; nulls are marked so they do not vanish from ``concat_ws``."""
    names = key if key else df.columns
    parts = [F.coalesce(col(c).cast("string"), F.lit(_NULL_MARK)) for c in names]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _tie_columns(df: DataFrame) -> dict[str, Column]:
    """All columns as order columns under names of their own; nested ones as text."""
    return {f"_tie{i}": col(f.name).cast("string") if isinstance(f.dataType, _NESTED) else col(f.name)
            for i, f in enumerate(df.schema.fields)}


def allocate(class_counts: dict, n_first: int) -> dict:
    """Per-class share of ``n_first`` rows by largest remainder (ties by class value)."""
    n = sum(class_counts.values())
    if n == 0:
        return {c: 0 for c in class_counts}
    base = {c: (k * n_first) // n for c, k in class_counts.items()}
    rem = {c: (k * n_first) % n for c, k in class_counts.items()}
    left = n_first - sum(base.values())
    for c in sorted(class_counts, key=lambda c: (-rem[c], _sort_key(c)))[:left]:
        base[c] += 1
    return base


def _sort_key(v):
    return (v is None, str(type(v)), v if v is not None else 0)


def split_sizes(class_counts: dict, test_size: float, rounding: str = "ceil") -> dict:
    """``{class: n_test}``; the reference's rules (and its errors) for stratified splits."""
    n = sum(class_counts.values())
    n_test = math.ceil(test_size * n) if rounding == "ceil" else int(math.floor(test_size * n))
    n_train = n - n_test
    if n_test <= 0 or n_train <= 0:
        raise ValueError(f"test_size={test_size} leaves an empty side for {n} rows")
    if len(class_counts) > 1:
        if min(class_counts.values()) < 2:
            raise ValueError("the least populated class has only 1 member; stratification needs 2")
        if n_test < len(class_counts) or n_train < len(class_counts):
            raise ValueError("each side must hold at least one row per class")
    train = allocate(class_counts, n_train)
    return {c: class_counts[c] - train[c] for c in class_counts}


def _class_table(hdf: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    """``rows`` (one per class, class first) as a frame; broadcast while it is small."""
    dtype = hdf.schema["_cls"].dataType.simpleString()
    table = hdf.sparkSession.createDataFrame(rows, f"_c {dtype}, {columns}")
    return F.broadcast(table) if len(rows) <= _BROADCAST_ROWS else table


def _prefix_counts(hdf: DataFrame, depth: int, at: dict | None = None) -> DataFrame:
    """``(_cls, _p, _n)``: rows per class and hash prefix; with ``at`` ({class: prefix})
    only those under the class's prefix."""
    if at is not None:
        state = _class_table(hdf, list(at.items()), "_at string")
        hdf = hdf.join(state, hdf["_cls"].eqNullSafe(state["_c"]) & F.col("_h").startswith(F.col("_at")))
    return hdf.groupBy("_cls", F.substring("_h", 1, depth).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))


def _boundaries(counts: DataFrame, ranks: dict, before: dict) -> dict:
    """``{class: (prefix, rows before it, rows in it)}`` of the bucket that holds the
    class's rank. Summed up on executors (at most 65,536 buckets a class); one row per
    class is collected."""
    wanted = _class_table(counts, [(c, ranks[c], before[c]) for c in ranks], "_rank long, _before long")
    run = counts.withColumn("_run", F.sum("_n").over(Window.partitionBy("_cls").orderBy("_p")))
    run = run.join(wanted, run["_cls"].eqNullSafe(wanted["_c"])).withColumn("_start", F.col("_before") + F.col("_run") - F.col("_n"))
    hit = run.where((F.col("_start") < F.col("_rank")) & (F.col("_start") + F.col("_n") >= F.col("_rank")))
    return {r["_cls"]: (r["_p"], r["_start"], r["_n"]) for r in hit.select("_cls", "_p", "_start", "_n").collect()}


def _window(n: int, rank: int) -> tuple[str, str]:
    """The hashes (from, before) among which that of the ``rank``-th of ``n`` even ones lies."""
    share = rank / n
    half = _SIGMAS * math.sqrt(share * (1 - share) / n) + 8 / n
    low, high = (min(max(share + d, 0.0), 1.0) * 16 ** 8 for d in (-half, half))
    return f"{int(low):08x}", f"{math.ceil(high):08x}" if high < 16 ** 8 else "g"


def _near_thresholds(hdf: DataFrame, ranks: dict, counts: dict) -> dict | None:
    """What ``_thresholds`` finds, by one scan of the hashes; None where a rank does not lie in
    its window, or a window would be long."""
    if max(2 * _SIGMAS * math.sqrt(counts[c]) for c in ranks) > _LIST_LIMIT * 16:
        return None
    state = _class_table(hdf, [(c, *_window(counts[c], ranks[c])) for c in ranks], "_low string, _high string")
    near = hdf.join(state, hdf["_cls"].eqNullSafe(state["_c"]) & (F.col("_h") < F.col("_high")))
    near = near.groupBy("_cls", F.when(F.col("_h") >= F.col("_low"), F.col("_h")).otherwise("").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    found = _boundaries(near, ranks, dict.fromkeys(ranks, 0))
    if any(c not in found or not found[c][0] for c in ranks):
        return None
    return {c: (p, ranks[c] - start - 1) for c, (p, start, _) in found.items()}


def _thresholds(hdf: DataFrame, ranks: dict, level1: DataFrame) -> dict:
    """For each class, ``(T, k)``: T = h of the row with 1-based rank ``ranks[c]``;
    k = how many rows with h == T come before it (0 unless keys repeat).

    ``level1`` holds the first-level prefix counts of the caller. Each further level is
    one scan for all classes; once every bucket is small it is resolved to whole hashes.
    """
    depth, found = _PREFIX, _boundaries(level1, ranks, dict.fromkeys(ranks, 0))
    while depth < _HASH_DIGITS:
        small = max(n for _, _, n in found.values()) <= _LIST_LIMIT
        depth = _HASH_DIGITS if small else min(_HASH_DIGITS, depth + _PREFIX)
        counts = _prefix_counts(hdf, depth, {c: p for c, (p, _, _) in found.items()})
        found = _boundaries(counts, ranks, {c: start for c, (_, start, _) in found.items()})
    return {c: (p, ranks[c] - start - 1) for c, (p, start, _) in found.items()}


def assign_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, stratify_by: str | None = None,
                 key: list[str] | None = None, output: str = "split", rounding: str = "ceil") -> DataFrame:
    """Add ``output`` = 'test' | 'train' with exact per-class sizes.

    ``stratify_by=None`` is the plain split (one class).
    """
    h = order_hash(df, key, seed)
    cls = col(stratify_by) if stratify_by else F.lit(0)
    hdf = df.select(cls.alias("_cls"), h.alias("_h"))
    counts = {r["_cls"]: r["n"] for r in hdf.groupBy("_cls").agg(F.count(F.lit(1)).alias("n")).collect()}   # hashes nothing
    if not counts:
        return df.withColumn(output, F.lit(None).cast("string"))
    n_test = split_sizes(counts, test_size, rounding)
    # rank of the first TRAIN row in each class that is not all-test / all-train
    ranks = {c: n_test[c] + 1 for c in counts if 0 < n_test[c] < counts[c]}
    thr = _near_thresholds(hdf, ranks, counts) if ranks else {}
    if thr is None:
        level1 = _prefix_counts(hdf, _PREFIX).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            thr = _thresholds(hdf, ranks, level1)
        finally:
            level1.unpersist()
    rows = []
    for c in counts:
        if n_test[c] == 0:
            rows.append((c, "", 0, False))           # h < "" never holds: all train
        elif n_test[c] == counts[c]:
            rows.append((c, "g", 0, True))           # every hex string is < "g": all test
        else:
            rows.append((c, *thr[c], False))
    table = _class_table(hdf, rows, "_t string, _k long, _all boolean")
    with_h = df.withColumn("_h", h).withColumn("_cls", cls)
    joined = with_h.join(table, with_h["_cls"].eqNullSafe(table["_c"]), "left").drop("_c")
    is_test = F.col("_all") | (F.col("_h") < F.col("_t"))
    if not any(r[2] > 0 for r in rows):
        return joined.withColumn(output, F.when(is_test, "test").otherwise("train")) \
            .drop("_h", "_cls", "_t", "_k", "_all")
    # repeated keys straddle the boundary: the tied rows are ordered by all columns and
    # ranked in blocks, however many there are
    main = joined.where(F.col("_h") != F.col("_t")) \
        .withColumn(output, F.when(is_test, "test").otherwise("train"))
    ties = _tie_columns(df)
    tied = joined.where(F.col("_h") == F.col("_t")).withColumns(ties)
    tied = prefix_before(tied, ["_cls"], list(ties), out="_rn", max_blocks=_TIE_BLOCKS) \
        .withColumn(output, F.when(F.col("_rn") < F.col("_k"), "test").otherwise("train")).drop("_rn", *ties)
    return main.unionByName(tied).drop("_h", "_cls", "_t", "_k", "_all")


def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, stratify_by: str | None = None,
                     key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """F8 convenience: ``(train, test)`` frames; the split column is dropped."""
    marked = assign_split(df, test_size, seed, stratify_by, key, "_split")
    return (marked.where("_split = 'train'").drop("_split"), marked.where("_split = 'test'").drop("_split"))


def holdout(df: DataFrame, fraction: float = 0.2, seed: int = 7, key: list[str] | None = None,
            output: str = "is_validation") -> DataFrame:
    """validation share = ``floor(n * fraction)`` rows, non-stratified, as a
    boolean column (usable as GBT's ``validationIndicatorCol``)."""
    marked = assign_split(df, fraction, seed, None, key, "_split", rounding="floor")
    return marked.withColumn(output, F.col("_split") == "test").drop("_split")


def assign_folds(df: DataFrame, k: int = 3, seed: int = 42, stratify_by: str | None = None,
                 key: list[str] | None = None, output: str = "fold") -> DataFrame:
    """``fold = (rank in class by h) mod k`` -> class-balanced folds of equal size.

    The hash deals the rows evenly to buckets by its first digits, so the rank is the rows
    of the class in earlier buckets plus the place in the row's own bucket: one count and
    one shuffle. Buckets that a repeated key fills are ranked by distributed prefix counts
    (``prefix_before``); no class is ever sorted in one task.
    """
    h = order_hash(df, key, seed)
    cls = col(stratify_by) if stratify_by else F.lit(0)
    tagged = df.withColumn("_h", h).withColumn("_cls", cls)
    # rows that tie on the key are told apart by all their columns, so that the folds do
    # not depend on the partitioning (equal rows are interchangeable)
    ties = _tie_columns(df)
    fold = lambda rank: (rank % k).cast("int")
    done = ["_h", "_cls"]
    rank = lambda *part: F.row_number().over(Window.partitionBy(*part).orderBy("_h", *ties.values())) - 1
    n = df.count()
    if n <= _BUCKET_ROWS:
        return tagged.withColumn(output, fold(rank("_cls"))).drop(*done)
    digits = min(_HASH_DIGITS, math.ceil(math.log(n / _BUCKET_ROWS, 16)))
    bucket = F.substring("_h", 1, digits).alias("_b")
    # one row a class and bucket: its rows, and those of the class before it
    sizes = cut_lineage(df.select(cls.alias("_cls"), h.alias("_h")).groupBy("_cls", bucket).agg(F.count(F.lit(1)).alias("_n")))
    earlier = Window.partitionBy("_cls").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_cls").alias("_c"), F.col("_b").alias("_at"), (F.col("_n") > _FULL_BUCKET).alias("_full"),
                          F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    head = sizes.agg(F.count(F.lit(1)), F.max("_n")).first()
    starts = F.broadcast(starts) if head[0] <= _BROADCAST_ROWS else starts
    done += ["_b", "_c", "_at", "_full", "_start"]
    known = tagged.withColumn("_b", bucket)
    known = known.join(starts, known["_cls"].eqNullSafe(starts["_c"]) & (known["_b"] == starts["_at"]))
    out = known.where("NOT _full").withColumn(output, fold(F.col("_start") + rank("_cls", "_b")))
    if head[1] > _FULL_BUCKET:                             # a key that repeats: its rows are cut by all columns
        full = known.where("_full").withColumns(ties)
        full = prefix_before(full, ["_cls", "_b"], ["_h", *ties], out="_before", max_blocks=_TIE_BLOCKS)
        out = out.unionByName(full.withColumn(output, fold(F.col("_start") + F.col("_before"))).drop("_before", *ties))
    return out.drop(*done)
