r"""op12: benchmark passages in documents, by a prefix-filtered set join.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased. A window is ten
consecutive words of an item (the whole item if it has fewer), its set the three-word
shingles it holds (the whole window if it has fewer words). A window occurs only where all
of its shingles do, so one shingle is enough as its necessary prefix: the rarest one.

1. Windows: distinct word sequences with their shingles, and the items each belongs to.
2. Rarity: one pass over the documents counts the windows' shingles. Tasks skip other
   shingles by a bit filter of fixed size (``FILTER_BITS``); what it lets through wrongly
   goes in the join. Windows with a shingle that no document holds are dropped there.
3. Candidates: a second pass writes one row per document with its word count and the
   places of possible prefix shingles, each with the words around it.
4. Join on the prefix shingle. Bounds on the position (the window must not begin before
   the first word) and the length (nor end after the last) come first, then the words
   are compared, so a clash of hashes cannot count. A shingle that many documents share
   makes a large key, which Spark's skew join splits.
5. Per document, occurrences are united by position, and item ids are digested.

A null or empty text has no words; a null item_id is the item ``''``; rows of the
benchmark with one id are one item. Repeated documents each get a row; very long texts
are hashed about a megabyte of whole rows at a time. Only doc_id, text and item_id are
read, so other columns may have any names. An empty benchmark leaves every document
clean; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import LOWER, LOWER_CODE, PLACE_CODE, Chunk, mix64, run_starts, shared_table, span_hashes, table, text_chunks

WINDOW = 10                 # words of a window
SHINGLE = 3                 # words of a shingle
FILTER_BITS = 1 << 26       # 8 MB sent to every worker, whatever the size of the benchmark
HELD_SHINGLES = 1 << 20     # counted shingles a task holds before it sends them

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a chunk's words, and the first word of each row (and the end)."""
    inside = np.zeros(len(chunk.buf) + 1, bool)
    inside[:-1] = WORD[chunk.buf]
    edge = np.zeros(len(chunk.buf) + 1, bool)
    edge[chunk.offsets] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1] & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, chunk.offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every shingle of ``order`` words that lies in one row."""
    n = max(0, len(hashes) - order + 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[:n] == row[order - 1:order - 1 + n])
    total = np.full(len(at), PLACE_CODE[40 + order], np.uint64)
    for k in range(order):
        total += hashes[at + k] * PLACE_CODE[k]
    return mix64(total), at


def windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, n, shingles): every window of every item; shingles by offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for chunk in text_chunks(batch.column("text")):
                starts, ends, first = spans(chunk)
                hashes = span_hashes(LOWER_CODE[chunk.buf], starts, ends)
                low = LOWER[chunk.buf].tobytes()
                words = [low[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                out = {"item_id": [], "words": [], "n": [], "shingles": []}
                for row in range(chunk.size):
                    a, b = int(first[row]), int(first[row + 1])
                    if b == a:
                        continue
                    size, order = min(WINDOW, b - a), min(SHINGLE, b - a)
                    codes = shingles(hashes[a:b], np.array([0, b - a]), order)[0].view(np.int64)
                    for i in range(a, b - size + 1):
                        out["item_id"].append(ids[chunk.first + row])
                        out["words"].append(" ".join(words[i:i + size]))
                        out["n"].append(size)
                        out["shingles"].append(codes[i - a:i - a + size - order + 1].tolist())
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("item_id", pa.string()), ("words", pa.string()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))])
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id string, words string, n int, shingles array<long>")


def bit_filter(codes: DataFrame) -> np.ndarray:
    """Bits set for the 64-bit column ``code``: 32-bit words of a filter of fixed size, or'ed
    by Spark; at most FILTER_BITS / 32 rows come back."""
    marks = codes.select(F.explode(F.array(F.col("code").bitwiseAND(F.lit(FILTER_BITS - 1)),
                                           F.shiftrightunsigned("code", 32).bitwiseAND(F.lit(FILTER_BITS - 1)))).alias("bit"))
    rows = marks.groupBy(F.shiftright("bit", 5).alias("at")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 31 AS int))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return bits


def _passes(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.ones(len(codes), bool)
    for shift in (np.uint64(0), np.uint64(32)):
        bit = (codes >> shift) & np.uint64(FILTER_BITS - 1)
        out &= (bits[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
    return out


def _hits(chunk: Chunk, bits: np.ndarray, orders: list[int]):
    """Spans of the chunk, first word of each row, and code and place of the shingles that pass."""
    starts, ends, first = spans(chunk)
    hashes = span_hashes(LOWER_CODE[chunk.buf], starts, ends)
    codes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for order in orders:
        code, at = shingles(hashes, first, order)
        ok = _passes(bits, code)
        codes.append(code[ok])
        places.append(at[ok])
    return starts, ends, first, np.concatenate(codes), np.concatenate(places)


def shingle_counts(docs: DataFrame, bits: np.ndarray, orders: list[int]) -> DataFrame:
    """(code, cnt): how often the documents hold each shingle that passes the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.sort(np.concatenate(held))
        first = run_starts(codes)
        return pa.RecordBatch.from_arrays([pa.array(codes[first].view(np.int64)), pa.array(np.diff(np.append(first, len(codes))).astype(np.int64))],
                                          names=["code", "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                held.append(_hits(chunk, sent.value, orders)[3])
                size += len(held[-1])
                if size >= HELD_SHINGLES:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return docs.select("text").mapInArrow(run, "code long, cnt long").groupBy("code").agg(F.sum("cnt").alias("cnt"))


def candidates(docs: DataFrame, bits: np.ndarray, orders: list[int]) -> DataFrame:
    """doc_id, n_words and the possible prefix shingles of every document: code, place, the
    number of words before it that are given, and those words, itself and the ones after."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    id_type = dict(docs.dtypes)["doc_id"]
    reach = WINDOW - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, sizes, code, place, before, around = [], [], [], [], [], []
            for chunk in text_chunks(batch.column("text")):
                starts, ends, first, codes, at = _hits(chunk, sent.value, orders)
                row = np.searchsorted(first, at, "right") - 1
                order = np.argsort(row, kind="stable")
                codes, at, row = codes[order], at[order], row[order]
                n_words.append(np.diff(first))
                sizes.append(np.bincount(row, minlength=chunk.size))
                code.append(codes.view(np.int64))
                place.append(at - first[row])
                a, b = np.maximum(first[row], at - reach), np.minimum(first[row + 1], at + reach + 1)
                before.append(at - a)
                low = LOWER[chunk.buf].tobytes() if len(at) else b""
                around += [b" ".join(low[starts[k]:ends[k]] for k in range(i, j)).decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
            join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            found = pa.StructArray.from_arrays(
                [pa.array(join(code)), pa.array(join(place).astype(np.int32)), pa.array(join(before).astype(np.int32)), pa.array(around, pa.string())],
                names=["code", "place", "before", "around"])
            offsets = np.concatenate(([0], np.cumsum(join(sizes)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(join(n_words).astype(np.int64)),
                                              pa.ListArray.from_arrays(pa.array(offsets), found)], names=["doc_id", "n_words", "found"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, found array<struct<code: long, place: int, before: int, around: string>>")


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (row, doc_id, n_words), occurrences (row, start, n, words) and windows
    (words, n, shingles, item_id)."""
    spark = docs.sparkSession
    of_items = shared_table(windows(benchmark), "benchmark-windows", spark)
    distinct = of_items.groupBy("words").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    orders = sorted(r.k for r in distinct.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect())  # 1 to SHINGLE
    offset = distinct.select("words", "n", F.posexplode("shingles").alias("at", "code"))
    counts = shingle_counts(docs, bit_filter(offset.select("code")), orders)
    rarest = offset.join(counts, "code", "left") \
        .groupBy("words", "n").agg(F.min(F.struct(F.coalesce("cnt", F.lit(0)).alias("cnt"), "code", "at")).alias("least"))
    prefix = shared_table(rarest.where("least.cnt > 0").select("words", "n", "least.code", "least.at"), "benchmark-prefixes", spark)

    rows = candidates(docs, bit_filter(prefix.select("code")), orders).withColumn("row", F.monotonically_increasing_id())
    rows = shared_table(rows, "decontaminate-documents", spark)      # written: a row keeps its number
    place = rows.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    begin = F.col("place") - F.col("at")
    seen = F.array_join(F.slice(F.split("around", " ", -1), F.col("before") - F.col("at") + 1, F.col("n")), " ")
    fits = (begin >= 0) & (begin + F.col("n") <= F.col("n_words"))
    same = F.when(fits, seen == F.col("words")).otherwise(False)
    pairs = place.alias("p").join(prefix.alias("w"), (F.col("p.code") == F.col("w.code")) & same)
    found = pairs.select("row", begin.alias("start"), "n", "words").distinct()
    return rows.select("row", "doc_id", "n_words"), shared_table(found, "benchmark-occurrences", spark), of_items


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence), n_items,
    items_sha256 (of the sorted, comma-joined ids) and contaminated."""
    rows, found, of_items = occurrences(docs, benchmark)
    earlier = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(earlier), F.lit(0))))
    hit = found.select("row", "start", "n").distinct().select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    items = found.select("row", "words").distinct().join(of_items.select("words", "item_id").distinct(), "words") \
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hit, "row", "left").join(items, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT coalesce(item_id::varchar, '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
gram AS (
  SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS t(i)),
occ AS (SELECT g.row, g.i, g.n, win.item_id FROM gram g JOIN win ON win.words = g.words AND win.n = g.n),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM occ) GROUP BY row),
ids AS (
  SELECT row, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT row, item_id FROM occ) GROUP BY row)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (row) LEFT JOIN ids USING (row)
"""
