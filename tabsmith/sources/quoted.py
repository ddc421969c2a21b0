"""Records of CSV files whose quoted fields hold line breaks, each byte range read by its
own task (S2).

A file is read as plain lines, which Spark splits into byte ranges. At the start of a line
a reader is in one of two states: at a new record, or inside quotes. What a range does to
the two states (keep, swap, or fix them) is found by a first pass of all ranges side by
side; the state each range begins in is a prefix over these small tables, one row a range.
A second pass cuts every range into records. Only a record that crosses into another range
is put together by a shuffle: the range's last piece, and the first pieces of those after it.

Quotes open a field only at its start (after blanks); doubled quotes inside are text. Lines
end with LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_RANGES = 100_000   # tables of range states up to this size are broadcast


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a reader is inside quotes after ``line``, if it was ``inside`` before it."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            while line[at:at + 1] in (" ", "\t") and line[at:at + 1] != sep and at < len(line):
                at += 1
            inside = line[at:at + 1] == '"'
            at += inside
        while inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            inside = line[quote + 1:quote + 2] == '"'
            at = quote + 1 + inside
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("id"))


def _by_range(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[str]]]:
    """((file, block, ...), lines) of each range; a range's lines come one after the other."""
    def rows():
        for batch in batches:
            keys = zip(*[batch.column(n).to_pylist() for n in ("file", "block", *names)], strict=True)
            yield from zip(keys, batch.column("value").to_pylist(), strict=True)

    from itertools import groupby

    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, (value for _, value in group)


def range_states(lines: DataFrame, sep: str = ",") -> DataFrame:
    """(file, block, inside): the state in which each range begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), values in _by_range(batches):
            out, inside = False, True                      # from a new record, and from inside quotes
            for line in values:
                if '"' in line:
                    out = ends_inside(line, out, sep)
                    inside = ends_inside(line, inside, sep)
            yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "after_new": [out], "after_inside": [inside]})

    ranges = lines.select("file", "block", "value").mapInArrow(run, "file string, block long, after_new boolean, after_inside boolean")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.sum((F.col("after_new") & ~F.col("after_inside")).cast("int"))
    ranges = ranges.withColumns({"swaps": F.coalesce(swaps.over(earlier), F.lit(0)), "swaps_with": swaps.over(upto)})
    # the last range that ends the same whatever it began in, and the swaps since then
    fixed = F.when(F.col("after_new") == F.col("after_inside"), F.struct(F.col("after_new").cast("int").alias("state"), "swaps_with"))
    last = F.last(fixed, ignorenulls=True).over(earlier)
    state = F.coalesce(last["state"], F.lit(0)) + F.col("swaps") - F.coalesce(last["swaps_with"], F.lit(0))
    return ranges.select("file", "block", (F.pmod(state, F.lit(2)) == 1).alias("inside"))


def quoted_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``record``: the text of every record but each file's first one (its header)."""
    lines, pieces = _lines(spark, path), "file string, block long, n int, open boolean, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("open", pa.bool_()), ("text", pa.string())])
        for (file, block, inside), values in _by_range(batches, "inside"):
            # n = -1: the rest of a record that an earlier range began
            n, held, done = -1 if inside else 0, [], []
            for line in values:
                held.append(line)
                inside = ends_inside(line, inside, sep)
                if not inside:
                    done.append((n, "\n".join(held)))
                    n, held = max(n, -1) + 1, []
                    if len(done) >= 10_000:
                        yield pa.RecordBatch.from_pydict({"file": [file] * len(done), "block": [block] * len(done), "n": [d[0] for d in done],
                                                          "open": [d[0] < 0 for d in done], "text": [d[1] for d in done]}, schema=schema)
                        done = []
            if held:
                done.append((n, "\n".join(held)))
            yield pa.RecordBatch.from_pydict({"file": [file] * len(done), "block": [block] * len(done), "n": [d[0] for d in done],
                                              "open": [d[0] < 0 or (bool(held) and d is done[-1]) for d in done],
                                              "text": [d[1] for d in done]}, schema=schema)

    states = range_states(lines, sep).persist()
    few = states.count() <= BROADCAST_RANGES
    known = lines.join(F.broadcast(states) if few else states, ["file", "block"])
    if not few:                                            # a shuffle takes the lines out of their order
        known = known.sortWithinPartitions("file", "block", "id")
    rows = known.select("file", "block", "inside", "value").mapInArrow(cut, pieces)
    whole = rows.where("NOT open").select("text", (F.expr("block = 0 AND n = 0")).alias("header"))
    order = Window.partitionBy("file").orderBy("block", "n")
    parts = rows.where("open").withColumn("chain", F.sum((F.col("n") >= 0).cast("int")).over(order))
    joined = parts.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("block", "n", "text"))).alias("p")) \
        .select(F.array_join(F.col("p.text"), "\n").alias("text"), F.expr("p[0].block = 0 AND p[0].n = 0").alias("header"))
    text = F.regexp_replace("text", "\r$", "")
    return whole.unionByName(joined).where("NOT header").select(text.alias("record")).where("record <> ''")
