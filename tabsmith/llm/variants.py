r"""op11: spelling variants of words, by a variable-length gram index.

1. Words: runs of letters ``[A-Za-zÀ-ÿ]+`` (A-Z lower-cased) are counted;
   those long and frequent enough form the vocabulary.
2. Gram dictionary: grams start with two letters and grow while they are too frequent.
   A gram met more than 1 / ``DICTIONARY_SHARE`` of all times is ``open``; at each place of
   a word the gram ends with the first prefix that is not open, at ``MAX_GRAM`` letters, or
   with the end mark after the last letter. There can be no more than DICTIONARY_SHARE
   open grams of a length, so the dictionary is bounded.
3. Decomposition: the gram at every place, without those that lie inside the one before.
   A gram is chosen by its own letters alone and stays while its prefixes are open, so an
   edit at place i changes only grams that end among the MAX_GRAM places after it: that
   is the bound of affected grams. All others are shared by both words.
4. List merging: the places of an edit are cut into zones of one to a few letters. For
   each zone, a word is put on the one list that stands for all of its grams which no edit
   in the zone affects (those before at their place from the front, those behind at their
   place from the back): the intersection of these grams' lists. Words of length l meet
   there words of length l and l + 1. Near words meet in the zone of their edit.
5. Verification: the join condition itself asks for an edit distance of one, so no
   candidate becomes a row.

Each word's form is its near word of the largest count, if that is ``factor`` times its
own; roots follow forms by pointer doubling.

Null texts have no words; a null doc_id stands as an empty id in the hash. Repeated rows
count again. Very long runs of letters are words like others. No rows give no words. Only
doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm.common import shared_table, table

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "([A-Za-zÀ-ÿ]+)"
END = "$"                    # no letter
MIN_GRAM, MAX_GRAM = 2, 3
DICTIONARY_SHARE = 8192
LETTERS_PER_ZONE_LETTER = 5  # zones are as wide as the length divided by this
HOPS = 64                    # a hop multiplies the count, so chains are far shorter


def words(docs: DataFrame, every: int = 31) -> DataFrame:
    """(word, n): lower-cased runs of letters of whole texts; one in ``every`` (chosen by
    the crc32 of ``doc_id:run``) loses one letter."""
    run = F.explode(F.regexp_extract_all("text", F.lit(LETTERS))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text").select("id", run)
    runs = runs.select("id", F.translate("run", UPPER, LOWERED).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")) \
        .groupBy("word").agg(F.count("*").alias("n"))


def open_grams(vocabulary: DataFrame, share: int = DICTIONARY_SHARE) -> set[str]:
    """The grams that are too frequent to end a decomposition: at most ``share`` a length."""
    out = set()
    for size in range(MIN_GRAM, MAX_GRAM):
        grams = vocabulary.select(F.explode(F.transform(
            F.sequence(F.lit(1), F.length("word") - size + 1), lambda i, size=size: F.substring("word", i, F.lit(size)))).alias("gram"))
        counts = grams.groupBy("gram").agg(F.count("*").alias("cnt"))
        total = counts.agg(F.sum("cnt").alias("t")).first().t or 0
        out |= {r.gram for r in counts.where(F.col("cnt") * share > total).select("gram").collect()}
    return out


def decompose(word: str, opened: set[str]) -> list[tuple[str, int, int]]:
    """(gram, place, end) of a word; ends rise."""
    text = word + END
    grams, reach = [], 0
    for i in range(len(word)):
        j = i + MIN_GRAM
        while j < len(text) and j - i < MAX_GRAM and text[i:j] in opened:
            j += 1
        if j > reach:                                  # else inside the gram before
            grams.append((text[i:j], i, j))
            reach = j
    return grams


@lru_cache(1 << 16)
def _code(gram: str) -> int:
    return int.from_bytes(blake2b(gram.encode(), digest_size=8).digest(), "little") | 1


def zone_width(length: int) -> int:
    return max(1, length // LETTERS_PER_ZONE_LETTER)


def list_keys(word: str, opened: set[str], min_length: int) -> tuple[set[int], set[int]]:
    """The lists of a word among words of its own length (as the shorter one of a pair, or
    of equal length), and among words with one letter less (as the longer one)."""
    grams, size, mask = decompose(word, opened), len(word), (1 << 64) - 1
    ends = [e for _, _, e in grams]
    front, back = [0], [0]
    for gram, place, _ in grams:
        front.append(front[-1] + _code(gram) * (2 * place + 1) & mask)
    for gram, place, _ in reversed(grams):
        back.append(back[-1] + _code(gram) * (2 * (size - place) + 1) * 0x9E3779B97F4A7C15 & mask)
    out = set(), set()
    for longer in (0, 1):
        length = size - longer                         # of the shorter word
        if length < min_length:
            continue
        width = zone_width(length)
        for low in range(0, length + 1, width):
            before = bisect_right(ends, low)
            behind = len(ends) - bisect_right(ends, min(low + width - 1, length) + MAX_GRAM + longer)
            key = front[before] + back[behind] + length * 0xD1B54A32D192ED03 & mask
            out[longer].add(key - (1 << 64) if key >> 63 else key)
    return out


def gram_lists(vocabulary: DataFrame, min_length: int) -> DataFrame:
    """(list, shorter, word, n): the lists of every word; ``shorter`` tells the two kinds."""
    opened = vocabulary.sparkSession.sparkContext.broadcast(open_grams(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, shorter, at = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for kind, keys in zip((True, False), list_keys(word, opened.value, min_length), strict=True):
                    lists += keys
                    shorter += [kind] * len(keys)
                    at += [i] * len(keys)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), pa.array(shorter, pa.bool_()),
                                              batch.column("word").take(at), batch.column("n").take(at)],
                                             names=["list", "shorter", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "list long, shorter boolean, word string, n long")


def near_pairs(vocabulary: DataFrame, min_length: int = 7) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of vocabulary words that differ by exactly
    one inserted, deleted or replaced code point. Words have ``min_length`` letters or more."""
    if min_length < 2 * MAX_GRAM + zone_width(min_length) - 2:
        raise ValueError("words this short can lose every gram to one edit")
    lists = shared_table(gram_lists(vocabulary, min_length), "gram-lists")
    short = lists.where("shorter").select("list", F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = lists.select(F.col("list").alias("b_list"), "shorter", F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = ~F.col("shorter") | (F.col("a") < F.col("b"))
    pairs = short.join(other, (F.col("list") == F.col("b_list")) & once & (F.levenshtein("a", "b", 1) == 1)) \
        .select("a", "a_n", "b", "b_n").distinct()
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                             F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    return pairs.select(both.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last one, by pointer doubling."""
    step = forms.select("word", F.col("form").alias("root"))
    for _ in range(HOPS.bit_length()):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = shared_table(moved, "roots")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return step
    return step


def spelling_variants(docs: DataFrame, min_length: int = 7, min_n: int = 2, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    vocabulary = shared_table(words(docs).where((F.length("word") >= min_length) & (F.col("n") >= min_n)), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(vocabulary, min_length).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * factor
    near = shared_table(near.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"),
                                    F.when(enough, -F.col("best.less")).alias("form_n")), "near-words")
    root = roots(near.where("form IS NOT NULL"))
    return vocabulary.join(near, "word", "left").join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE crc(step, t) AS (
  SELECT 0, list_transform(range(256), lambda x: x::bigint)
  UNION ALL
  SELECT step + 1, list_transform(t, lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM crc WHERE step < 8),
tab AS (SELECT t FROM crc WHERE step = 8),
occ AS (
  SELECT coalesce(doc_id::varchar, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
runs AS (SELECT id, run, count(*) AS c FROM occ GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(id || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::bigint] ELSE [195::bigint, (unicode(x) - 64)::bigint] END))),
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
  FROM runs, tab),
cut AS (
  SELECT c, CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) ELSE run END AS word
  FROM hashed),
v AS (SELECT word, sum(c)::bigint AS n FROM cut GROUP BY word HAVING length(word) >= 7 AND sum(c) >= 2),
del AS (
  SELECT word, n, i, substring(word, 1, i::int) || substring(word, i::int + 2) AS rest
  FROM v, unnest(range(0, length(word))) AS t(i)),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT x.word AS a, y.word AS b FROM del x JOIN del y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION ALL SELECT d.word, v.word FROM del d JOIN v ON v.word = d.rest
    UNION ALL SELECT v.word, d.word FROM del d JOIN v ON v.word = d.rest)),
near AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY y.n DESC, b) AS best, max(y.n) AS best_n
  FROM pairs JOIN v y ON y.word = b GROUP BY a),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form,
         CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN near USING (word)),
chain(word, root, hop) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL SELECT c.word, f.form, hop + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, hop) AS root FROM chain GROUP BY word)
SELECT word, form, root, n::bigint AS n, n_near::bigint AS n_near, form_n::bigint AS form_n FROM forms JOIN last USING (word)
"""
