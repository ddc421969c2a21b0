"""op13: phrase collocations by mergeable Misra-Gries summaries, then an exact count.

1. ``units``: texts of one language are lower-cased (A-Z) and packed into units of about
   ``UNIT_BYTES``, written once to the shared folder; a unit never changes afterwards.
2. Every unit counts its own n-grams of one to four words (never across a piece boundary)
   and deals them by hash to partitions: one packed blob of sorted 64-bit hashes and
   counts for each unit and partition. The partition comes from a second, independent
   hash, so an n-gram is told apart by 64 bits and its partition number together; the
   number of partitions grows with the input.
3. A partition of mass M (occurrences) merges its blobs into a Misra-Gries summary of
   M // min_count + 1 counters. Whenever there are more, the count of the first counter
   beyond the capacity c is taken off all and those left empty go. Each such step removes
   it at least c + 1 times, so no counter loses more than M / (c + 1) < min_count: every
   n-gram met ``min_count`` times survives. A second pass over the same blobs counts the
   survivors exactly.
4. One unit that holds a frequent n-gram is told to spell it (chosen by a hash, so that no
   unit has to spell most of them). Cuts, scores and the rule on longer phrases are then
   joins of that table of frequent phrases with itself.

Null texts are empty; a null language is ``und``. Very long texts are one unit of their
own. Repeated rows count again. No rows give no phrases. Only ``lang`` and ``text`` are
read, so other columns may have any names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import (BYTE_CODE, LOWER, PLACE_CODE, bucket_of, input_bytes, mix64, pack, run_starts, runs,
                                 shared_table, span_hashes, table, text_buffer, unpack)

UNIT_BYTES = 3 << 20
HELD_BYTES = 12 << 20       # text of all languages that a task holds before it writes units
PARTITION_BYTES = 4 << 20   # of the input, a partition of n-grams
HASH_BYTES = 1 << 20        # text hashed at a time
RANK_SHARES = 64
MERGE_ENTRIES = 1 << 19     # blob entries merged into a summary at a time

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09]] = True
PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BREAK = np.frombuffer(b"\n", np.uint8)
_SECOND = np.uint64(0xD1B54A32D192ED03)


# ------------------------------------------------------------------ units

def units(docs: DataFrame) -> DataFrame:
    """unit, lang, n_words and the packed text of each unit, in a shared table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def flush(langs: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in langs:
                buf = np.concatenate(held.pop(lang))
                del size[lang]
                starts, _, _ = words_and_pieces(buf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([lang]), pa.array([len(starts)], pa.int64()),
                     pa.array([zstandard.ZstdCompressor(level=1).compress(buf.tobytes())], pa.binary())],
                    names=["unit", "lang", "n_words", "text"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            buf, offsets = text_buffer(batch.column("text"))
            for row, lang in enumerate(langs):
                text = buf[offsets[row]:offsets[row + 1]]
                if len(text):
                    held.setdefault(lang, []).extend((LOWER[text], _BREAK))
                    size[lang] = size.get(lang, 0) + len(text) + 1
                    if size[lang] >= UNIT_BYTES:
                        yield from flush([lang])
                    elif sum(size.values()) >= HELD_BYTES:
                        yield from flush(list(held))
        yield from flush(list(held))

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return shared_table(rows.mapInArrow(build, "unit string, lang string, n_words long, text binary"), "phrase-units")


def words_and_pieces(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a unit, and the piece each of them lies in."""
    end = PIECE_END[buf]
    word = np.zeros(len(buf) + 2, bool)
    word[1:-1] = ~(SPACE[buf] | end)
    starts = np.flatnonzero(word[1:-1] & ~word[:-2])
    ends = np.flatnonzero(word[1:-1] & ~word[2:]) + 1
    return starts, ends, np.cumsum(end, dtype=np.int32)[starts]


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        out[i:j] = span_hashes(BYTE_CODE[buf[a:b]], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def ngram_hashes(words: np.ndarray, pieces: np.ndarray, lang: str, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash before its last mixing of every n-gram of ``order`` words inside one piece, and
    the first word of each."""
    n = max(0, len(words) - order + 1)
    at = np.flatnonzero(pieces[:n] == pieces[order - 1:order - 1 + n])
    salt = np.frombuffer(lang.encode(), np.uint8)
    language = span_hashes(BYTE_CODE[salt], np.array([0]), np.array([len(salt)])) * np.uint64(2 * order + 1)
    total = np.full(len(at), language[0], np.uint64)
    for k in range(order):
        total += words[at + k] * PLACE_CODE[k]
    return total, at


def _identity(total: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, hash): two independent mixings of the same n-gram."""
    return bucket_of(mix64((total ^ _SECOND) * PLACE_CODE[62]), partitions), mix64(total.copy())


# ------------------------------------------------------------------ counting

def partition_count(docs: DataFrame) -> int:
    size = input_bytes(docs)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(12, size // PARTITION_BYTES) if size else least


def deal(parts: DataFrame, partitions: int, max_words: int) -> DataFrame:
    """(part, unit, mass, blob): the n-grams of each unit, dealt to partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
                starts, ends, pieces = words_and_pieces(buf)
                words = _word_hashes(buf, starts, ends)
                found = []
                for order in range(1, max_words + 1):
                    total, _ = ngram_hashes(words, pieces, row["lang"], order)
                    total.sort()                    # equal n-grams have equal totals
                    first = run_starts(total)
                    found.append((total[first], np.diff(np.append(first, len(total))).astype(np.uint32)))
                del total, words, starts, ends, pieces, buf
                count = np.concatenate([f[1] for f in found])
                part, key = _identity(np.concatenate([f[0] for f in found]), partitions)
                del found
                part = part.astype(np.uint16 if partitions <= 1 << 16 else np.uint64)
                order = np.argsort(key).astype(np.uint32)         # a unit has fewer than 2^32 n-grams
                order = order[np.argsort(part[order], kind="stable")]
                part, key, count = part[order], key[order], count[order]
                del order
                rows = [(p, int(count[i:j].sum()), pack(np.diff(key[i:j], prepend=np.uint64(0)), count[i:j]))
                        for p, i, j in runs(part)]
                del part, key, count
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([row["unit"]] * len(rows)),
                         pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                        names=["part", "unit", "mass", "blob"])

    return parts.select("unit", "lang", "text").mapInArrow(run, "part long, unit string, mass long, blob binary")


def entries(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, count = unpack(blob)
    return np.cumsum(step, dtype=np.uint64), count.astype(np.int64)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters between two merges."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counters (of another summary, or plain counts), then shrink to the capacity."""
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate((self.counts, counts))[order]
        first = run_starts(keys)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            at = len(counts) - 1 - self.capacity
            off = int(np.partition(counts, at)[at])     # the largest count beyond the capacity
            self.lost += off
            left = counts > off
            keys, counts = keys[left], counts[left] - off
        self.keys, self.counts = keys, counts


def survivors(blobs: list[bytes], mass: int, min_count: int) -> np.ndarray:
    """Sorted hashes that a summary of enough counters keeps: all met ``min_count`` times
    or more, and some others."""
    summary = Summary(mass // min_count + 1)
    waiting, held = [], 0
    for k, blob in enumerate(blobs):
        waiting.append(entries(blob))
        held += len(waiting[-1][0])
        if held >= MERGE_ENTRIES or k == len(blobs) - 1:
            keys, counts = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting, held = [], 0
            summary.merge(keys, counts)
    return summary.keys


def frequent(dealt: DataFrame, min_count: int) -> DataFrame:
    """(unit, found): hashes and exact counts of the frequent n-grams that the unit is to spell."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        names = group.column("unit").to_pylist()
        # another order of units in every partition, so that spelling is spread over them
        order = sorted(range(len(names)), key=lambda i: hash_text(f"{part}:{names[i]}"))
        blobs = [group.column("blob")[i].as_buffer() for i in order]   # not copied
        kept = survivors(blobs, sum(group.column("mass").to_pylist()), min_count)
        exact, speller = np.zeros(len(kept), np.int64), np.full(len(kept), -1, np.int64)
        for k, blob in enumerate(blobs if len(kept) else []):
            keys, counts = entries(blob)
            at = np.minimum(np.searchsorted(kept, keys), len(kept) - 1)
            same = kept[at] == keys
            exact[at[same]] += counts[same]
            new = at[same][speller[at[same]] < 0]
            speller[new] = k
        wanted = np.flatnonzero(exact >= min_count)
        wanted = wanted[np.argsort(speller[wanted], kind="stable")]
        rows = [(names[order[k]], pack(kept[wanted[i:j]], exact[wanted[i:j]].astype(np.uint64)))
                for k, i, j in runs(speller[wanted])]
        return pa.table([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                        names=["unit", "found"])

    return dealt.groupBy("part").applyInArrow(run, "unit string, found binary")


def hash_text(text: str) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(span_hashes(BYTE_CODE[raw], np.array([0]), np.array([len(raw)]))[0])


def spell(parts: DataFrame, found: DataFrame, partitions: int, max_words: int) -> DataFrame:
    """(lang, phrase, k, a): every frequent n-gram once, its words joined by one space."""
    shape = "lang string, phrase string, k int, a long"

    def run(unit: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"lang": [], "phrase": [], "k": [], "a": []}
        if unit.num_rows and asked.num_rows:
            lang = unit.column("lang")[0].as_py()
            raw = zstandard.ZstdDecompressor().decompress(unit.column("text")[0].as_py())
            buf = np.frombuffer(raw, np.uint8)
            starts, ends, pieces = words_and_pieces(buf)
            words = _word_hashes(buf, starts, ends)
            keys, counts = (np.concatenate(x) for x in zip(*[unpack(b) for b in asked.column("found").to_pylist()], strict=True))
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            for n in range(1, max_words + 1):
                total, at = ngram_hashes(words, pieces, lang, n)
                key = mix64(total)
                hit = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                same = np.flatnonzero(keys[hit] == key)
                which, first = np.unique(hit[same], return_index=True)
                for w, i in zip(which.tolist(), at[same[first]].tolist(), strict=True):
                    out["phrase"].append(b" ".join(raw[a:b] for a, b in zip(starts[i:i + n].tolist(), ends[i:i + n].tolist(), strict=True)).decode())
                    out["a"].append(int(counts[w]))
                    out["lang"].append(lang)
                    out["k"].append(n)
        return pa.table([pa.array(out["lang"], pa.string()), pa.array(out["phrase"], pa.string()),
                         pa.array(out["k"], pa.int32()), pa.array(out["a"], pa.int64())], names=list(out))

    return parts.select("unit", "lang", "text").groupBy("unit").cogroup(found.groupBy("unit")).applyInArrow(run, shape)


# ------------------------------------------------------------------ phrases

def frequent_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4) -> tuple[DataFrame, DataFrame]:
    """The units, and (lang, phrase, k, a) of all phrases of one to ``max_words`` words that
    occur ``min_count`` times or more in a language, with exact counts."""
    partitions = partition_count(docs)
    parts = units(docs)
    found = frequent(deal(parts, partitions, max_words), min_count)
    return parts, shared_table(spell(parts, found, partitions, max_words), "phrases")


def collocations(docs: DataFrame, min_count: int = 30, max_words: int = 4, cover: int = 80,
                 scale: int = 2_000_000, keep: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``keep`` phrases of
    two to ``max_words`` words.

    The score of a cut is floor(scale * a / (l + r)), l and r the counts of its two parts;
    the lowest-scoring cut counts (ties: the earliest). A phrase goes if a longer one holds
    it with at least ``cover`` per cent of its count. Products are exact decimals."""
    parts, phrases = frequent_phrases(docs, min_count, max_words)
    words = F.split("phrase", " ", -1)
    piece = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    several = phrases.where("k >= 2").withColumn("w", words)
    cuts = several.select("lang", "phrase", "a", "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")) \
        .select("lang", "phrase", "a", "cut", piece(F.lit(1), F.col("cut")).alias("first"),
                piece(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"(CAST(a AS decimal(20,0)) * CAST({scale} AS decimal(10,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]) \
        .select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("s")) \
        .groupBy("lang", "phrase", "a").agg(F.min("s").alias("s"))

    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice(F.col("w"), i, n), " "))))
    longer = several.where("k >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = exact("longer") * 100 >= exact("a") * cover
    left_over = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
    # the best of each share of a language first, so that no task ranks more than RANK_SHARES x keep
    order = [F.desc("s.score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES))).orderBy(*order)
    front = left_over.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= keep).drop("rank")
    best = Window.partitionBy("lang").orderBy(*order)
    ranked = front.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    totals = parts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"),
        "n", F.col("s.score").cast("long").alias("score"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
words AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM words, (SELECT unnest(range(1, 5)) AS k), unnest(range(1, len(w) - k + 2)) AS t(i)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r,
         (2000000::hugeint * c.a) // (l.a + r.a) AS score
  FROM cand c, unnest(range(1, c.k)) AS t(cut)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covered AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM (SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM cand, unnest(range(2, k)) AS t(m), unnest(range(1, k - m + 2)) AS u(i)) x
  JOIN cand s ON s.lang = x.lang AND s.phrase = x.phrase
  WHERE 100::hugeint * x.longer >= 80::hugeint * s.a),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s ANTI JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase)
SELECT lang, rank::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n::bigint AS n, score::bigint AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
