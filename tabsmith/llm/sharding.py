"""op1: shards by fixed virtual slots and a versioned slot-to-shard map.

Every row hashes to one of ``N_SLOTS`` virtual slots. Bytes and rows are summed per
slot (map-side combined: one row per slot and task). The slot-to-shard map is the only
thing that decides placement: version 0 deals slots round-robin, and ``rebalance``
writes the next version by moving slots. The map has ``N_SLOTS`` rows whatever the
data, so collecting and broadcasting it is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import table
from tabsmith.session import ensure_checkpoint_dir

N_SLOTS = 4096
N_SHARDS = 16


def with_slots(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 and virtual_slot.

    The slot hash covers id and text, so rows that repeat an id with other texts spread;
    null ids and null texts hash like any other value.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(1)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def first_map(n_slots: int, n_shards: int) -> list[int]:
    """Version 0: round-robin."""
    return [slot % n_shards for slot in range(n_slots)]


def rebalance(old: Sequence[int], slot_bytes: Sequence[int], n_shards: int, tolerance: float = 0.0005) -> list[int]:
    """The next version of the map: slots move from the heaviest shard to the lightest
    while a move narrows their difference by more than ``tolerance`` of a mean shard;
    where no single slot fits, one slot each way is exchanged. Ties take the smaller
    number. Shards beyond the old ones start empty and receive slots the same way."""
    import bisect

    shard_of = list(old)
    held = [[] for _ in range(n_shards)]  # per shard: (bytes, slot), ascending
    load = [0] * n_shards
    for slot, shard in enumerate(shard_of):
        if slot_bytes[slot]:
            bisect.insort(held[shard], (slot_bytes[slot], slot))
            load[shard] += slot_bytes[slot]
    floor = max(1.0, tolerance * sum(load) / n_shards)

    def move(item, a, b):
        held[a].remove(item)
        bisect.insort(held[b], item)
        load[a] -= item[0]
        load[b] += item[0]
        shard_of[item[1]] = b

    for _ in range(4 * len(shard_of)):
        high = max(range(n_shards), key=lambda s: (load[s], -s))
        moved = False
        for low in sorted(range(n_shards), key=lambda s: (load[s], s)):
            gap = load[high] - load[low]
            if gap <= floor:
                break
            # the slot nearest to half the gap, from below
            i = bisect.bisect_right(held[high], (gap // 2, len(shard_of))) - 1
            single = held[high][i] if i >= 0 else None
            best, pair = (abs(gap - 2 * single[0]) if single else gap), None
            for item in held[high]:  # exchange: difference nearest to half the gap
                j = bisect.bisect_left(held[low], (item[0] - gap // 2, -1))
                for other in held[low][max(0, j - 1):j + 1]:
                    if 0 < item[0] - other[0] < gap and abs(gap - 2 * (item[0] - other[0])) < best:
                        best, pair = abs(gap - 2 * (item[0] - other[0])), (item, other)
                if best <= floor:
                    break
            if pair:
                move(pair[0], high, low)
                move(pair[1], low, high)
                moved = True
                break
            if single:
                move(single, high, low)
                moved = True
                break
        if not moved:
            break
    return shard_of


class SlotMap:
    """The stored map: Parquet rows (version, virtual_slot, shard) under ``path``.

    A version is written once and never changed; readers name the version they use.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, shard_of: Sequence[int]) -> None:
        rows = [(slot, int(shard)) for slot, shard in enumerate(shard_of)]
        frame = self.spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version}")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
                    map_path: str | None = None) -> DataFrame:
    """Place every row: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard
    (null under this law), virtual_slot, map_version.

    ``slot`` is the row's place in its shard, 0, 1, 2, ... without gaps: rows before it
    in the shard's earlier virtual slots (a prefix sum over the bounded map) plus its
    place within its own virtual slot. Shards are equal in bytes up to the grain of one
    slot; a single row larger than a mean shard cannot be split. Rows equal in every
    column keep an arbitrary but interchangeable order. An empty table gives no rows.
    """
    import uuid

    spark = docs.sparkSession
    rows = with_slots(docs, n_slots)
    totals = {r["virtual_slot"]: (r["bytes"], r["n_rows"]) for r in slot_totals(rows).collect()}  # <= n_slots rows
    slot_bytes = [totals.get(s, (0, 0))[0] for s in range(n_slots)]
    store = SlotMap(spark, map_path or f"{ensure_checkpoint_dir(spark)}/slot-map-{uuid.uuid4().hex}")
    store.write(0, start := first_map(n_slots, n_shards))
    store.write(1, shard_of := rebalance(start, slot_bytes, n_shards))

    before, seen = [], [0] * n_shards
    for slot, shard in enumerate(shard_of):
        before.append((slot, seen[shard]))
        seen[shard] += totals.get(slot, (0, 0))[1]
    offsets = spark.createDataFrame(before, "virtual_slot int, rows_before long")
    placement = store.read(1).join(offsets, "virtual_slot")
    # size proven: n_slots rows
    placed = rows.join(F.broadcast(placement), "virtual_slot")
    place = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rows_before") + F.row_number().over(place) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.lit(1).alias("map_version"))


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
