"""op10: mix sources to target weights with Sainte-Lague block quotas (DataFrame only).

1. Targets: sources share the corpus size by weight; a target stops at ``max_repeats``
   times its source's size, and the excess is shared again by weight (closed form over
   the sources sorted by the level at which each one stops).
2. Quotas: the mix is cut into equal blocks of a power of two of words (64 at most, fewer
   where the smallest target asks for it) and the blocks go to the
   sources with the highest quotients target / (2 j + 1). Quotients that every
   allotment contains, and those that none can contain, follow from bounds on the
   divisor, so about three quotients per source are ranked whatever the block count.
3. Selection: a source's documents lie end to end in the order of a seeded hash; its
   blocks are the equal cuts of that line. A quota beyond one pass takes whole passes;
   the rest is a run of blocks that starts at a seeded block and wraps around. As the
   line is in random order the run is a random choice, and only the documents at its two
   ends are taken in part.

Positions on the line are prefix sums in two levels (md5 prefix, then rows inside one
prefix), so a source that holds a third of all rows is cut into ``4096`` windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import shared_table, table, word_count

BLOCK_WORDS = 64            # largest block
BLOCKS_LEAST = 64           # blocks are small enough that every target holds this many, or one word
MAX_REPEATS = 3
SEED = 42
N_WEIGHTS = 3
N_SHARDS = 16


def order_key(doc_id, text, seed: int = SEED) -> F.Column:
    """Seeded order of the rows: md5 of seed, id and text digest; nulls count as empty."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size (words) and order_key."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       order_key(F.col("doc_id"), F.col("text"), seed).alias("order_key"))


def source_targets(rows: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target). Sources by code point, null last, weigh
    1, 2, 3, 1, ...; one row per source, so the windows here run over sources only."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    s = s.withColumn("weight", ((F.row_number().over(order) - 1) % N_WEIGHTS + 1).cast("long"))
    cap = F.col("source_size") * max_repeats
    level = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.withColumn("cap", cap).withColumn("total", F.sum("source_size").over(everything))
    upto = level.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("capped_before", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
          .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
    # what a unit of weight gets if exactly the sources before this one stop at their cap
    s = s.withColumn("rate", (F.col("total") - F.col("capped_before")).cast("double") / F.col("weight_left"))
    fits = F.col("rate") * F.col("weight") <= F.col("cap")
    # the first source that stays under its cap fixes the rate of all later ones
    s = s.withColumn("free_rate", F.max(F.when(fits, F.struct(-F.col("capped_before"), -F.col("weight_left"),
                                                              F.col("rate").alias("rate")))).over(everything)["rate"])
    target = F.when(F.col("free_rate").isNull() | (F.col("free_rate") * F.col("weight") > F.col("cap")),
                    F.col("cap").cast("double")).otherwise(F.col("free_rate") * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def block_quotas(targets: DataFrame, n_blocks) -> DataFrame:
    """Sainte-Lague seats: adds ``quota``. ``n_blocks`` is a column over ``targets``
    (the same in every row). Ties go to the source that comes first."""
    everything = Window.partitionBy()
    t = (targets.withColumn("n", n_blocks)
         .withColumn("all_target", F.sum("target").over(everything))
         .withColumn("k", F.count(F.lit(1)).over(everything)))
    share = F.when(F.col("all_target") > 0, F.col("target") / F.col("all_target")).otherwise(F.lit(0.0))
    # sum of round(target/d) = n bounds the divisor d, hence each source's seats (one to spare)
    low = F.greatest(F.lit(0), F.floor(share * (F.col("n") - F.col("k") / 2) - 0.5) - 1)
    high = F.ceil(share * (F.col("n") + F.col("k") / 2) + 0.5) + 1
    t = t.withColumn("sure", F.least(low, F.col("n")).cast("long")).withColumn(
        "most", F.when(F.col("target") > 0, F.least(high, F.col("n"))).otherwise(F.lit(0)).cast("long"))
    t = t.withColumn("given", F.sum("sure").over(everything))
    open_seats = t.where("most > sure").select("source", "n", "given", "target",
                                               F.explode(F.sequence(F.col("sure"), F.col("most") - 1)).alias("j"))
    rank = F.row_number().over(Window.orderBy(
        (F.col("target") / (2 * F.col("j") + 1)).desc(), F.col("source").asc_nulls_last(), F.col("j")))
    won = (open_seats.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.col("given"))
           .groupBy(F.col("source").alias("won_source")).agg(F.count(F.lit(1)).alias("won")))
    return (t.join(won, t["source"].eqNullSafe(won["won_source"]), "left")
            .select(*[t[c] for c in targets.columns],
                    (F.col("sure") + F.coalesce(F.col("won"), F.lit(0))).cast("long").alias("quota")))


def shard_quotas(targets: DataFrame, n_blocks, n_shards: int = N_SHARDS) -> DataFrame:
    """(source, shard, quota): integer quotas per shard. Seats are awarded in quotient
    order and Sainte-Lague is house-monotone, so shard s holds the seats gained between
    the allotments for s/n and (s+1)/n of the blocks; they add up to the whole quota."""
    whole = None
    for s in range(n_shards + 1):
        part = block_quotas(targets, F.floor(n_blocks * s / n_shards).cast("long")).select(
            "source", F.lit(s).alias("house"), F.col("quota").alias("seats"))
        whole = part if whole is None else whole.unionByName(part)
    gain = F.col("seats") - F.lag("seats", 1, 0).over(Window.partitionBy("source").orderBy("house"))
    return whole.withColumn("quota", gain).where("house > 0").select(
        "source", (F.col("house") - 1).alias("shard"), "quota")


def block_size(least_target, most: int = BLOCK_WORDS) -> F.Column:
    """The largest power of two of words, up to ``most``, that the least target holds
    BLOCKS_LEAST times; one word where there is none."""
    size = F.lit(1)
    for k in range(1, most.bit_length()):
        size = F.when(least_target >= (BLOCKS_LEAST << k), F.lit(1 << k)).otherwise(size)
    return size.cast("long")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, and the pieces of ``taken``:
    passes (whole repeats), head and tail (words at the start or end of the text that
    the partial pass takes; both 0 or size where it takes nothing or all of it), source.

    Null and empty texts have size 0 and are never taken; a source without words has
    target 0; an empty table gives no rows. Repeated rows are separate rows.
    """
    rows = shared_table(sized(docs, seed), "mix-sizes")
    targets = source_targets(rows, max_repeats)
    everything = Window.partitionBy()
    block = block_size(F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything), block_words)
    targets = targets.withColumn("block", block)
    plan = block_quotas(targets, F.round(F.sum("source_size").over(everything) / F.col("block")).cast("long"))
    block_words = F.col("block")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    start_hash = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"start{seed}"), F.coalesce("source", F.lit("")))), 1, 12),
                        16, 10).cast("long")
    quota = F.least(F.col("quota"), blocks * max_repeats)
    plan = (plan.withColumn("blocks", blocks).withColumn("quota", quota)
            .withColumn("passes", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(F.lit(0)))
            .withColumn("rest", F.col("quota") - F.col("passes") * F.col("blocks"))
            .withColumn("first", F.when(F.col("blocks") > 0, start_hash % F.col("blocks")).otherwise(F.lit(0))))
    # the run [first, first + rest) of blocks, in words; what wraps around starts at 0 again
    lo, hi = F.col("first") * block_words, (F.col("first") + F.col("rest")) * block_words
    line = F.col("blocks") * block_words
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target", F.col("passes").cast("long").alias("passes"),
                       lo.alias("a_lo"), F.least(hi, line).alias("a_hi"),
                       F.greatest(F.lit(0), hi - line).alias("b_hi"))

    rows = rows.withColumn("cut", F.substring("order_key", 1, 3))
    cuts = rows.groupBy("source", "cut").agg(F.sum("size").alias("cut_size"))
    before = F.sum("cut_size").over(Window.partitionBy("source").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.select(F.col("source").alias("cut_source"), F.col("cut").alias("cut_key"),
                       F.coalesce(before, F.lit(0)).alias("cut_start"))
    inside = Window.partitionBy("source", "cut").orderBy("order_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_cut", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("cut") == F.col("cut_key")))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    x, y = F.col("cut_start") + F.col("in_cut"), F.col("cut_start") + F.col("in_cut") + F.col("size")
    common = lambda a, b: F.greatest(F.lit(0), F.least(y, b) - F.greatest(x, a))
    tail_or_mid = common(F.col("a_lo"), F.col("a_hi"))
    wrapped = common(F.lit(0), F.col("b_hi"))
    partial = tail_or_mid + wrapped
    taken = F.least(F.col("passes") * F.col("size") + partial, F.col("size") * max_repeats)
    return rows.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.least(F.col("passes"), F.lit(max_repeats)).alias("passes"),
        F.greatest(F.lit(0), F.col("a_lo") - x).cast("long").alias("skip"), partial.cast("long").alias("part"),
        wrapped.cast("long").alias("wrapped"), "source", "order_key")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "passes")


# The same rules written out: every quotient of every source is ranked, and the line of
# a source is one running sum.
SQL = r"""
WITH d AS (SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('42|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS order_key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS pos, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight DESC, pos DESC) AS left_w,
    row_number() OVER (ORDER BY cap / weight, pos) AS level FROM w),
r AS (SELECT *, (total - capped)::DOUBLE / left_w AS rate FROM l),
f AS (SELECT *, (SELECT arg_min(rate, level) FROM r WHERE rate * weight <= cap) AS free FROM r),
t0 AS (SELECT source, pos, source_size, total,
    CASE WHEN free IS NULL OR free * weight > cap THEN cap::DOUBLE ELSE free * weight END AS target FROM f),
t AS (SELECT *, (SELECT max(b) FROM (SELECT unnest([1, 2, 4, 8, 16, 32, 64]) AS b)
    WHERE b = 1 OR b * 64 <= (SELECT min(target) FROM t0 WHERE target > 0)) AS block FROM t0),
q AS (SELECT source, pos, target / (2 * j + 1) AS quotient, j, round(total / block::DOUBLE)::BIGINT AS n
    FROM t, LATERAL (SELECT unnest(range(0, round(total / block::DOUBLE)::BIGINT)) AS j) WHERE target > 0),
a AS (SELECT source, count(*) AS quota FROM (SELECT source, n,
    row_number() OVER (ORDER BY quotient DESC, pos, j) AS rank FROM q) WHERE rank <= n GROUP BY source),
p AS (SELECT t.source, source_size, target, block, ceil(source_size / block::DOUBLE)::BIGINT AS blocks,
    least(coalesce(quota, 0), 3 * ceil(source_size / block::DOUBLE)::BIGINT) AS quota,
    ('0x' || left(md5('start42|' || coalesce(t.source, '')), 12))::BIGINT AS h
    FROM t LEFT JOIN a ON t.source IS NOT DISTINCT FROM a.source),
p2 AS (SELECT *, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS passes,
    CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS rest, CASE WHEN blocks > 0 THEN h % blocks ELSE 0 END AS first FROM p),
x AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY order_key, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x0 FROM d)
SELECT doc_id, size::BIGINT AS size, source_size, target, x.source, passes::BIGINT AS passes,
  least(passes * size + greatest(0, least(x0 + size, least((first + rest) * block, blocks * block)) - greatest(x0, first * block))
    + greatest(0, least(x0 + size, (first + rest - blocks) * block) - x0), 3 * size)::BIGINT AS taken
FROM x JOIN p2 ON x.source IS NOT DISTINCT FROM p2.source
"""
