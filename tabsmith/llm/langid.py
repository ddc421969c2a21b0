"""op4: language identification with bit-sliced n-gram Bloom filters.

One Bloom filter per language over its frequent byte n-grams, all of equal size and
with the same hash functions, stored slice-wise: slot s holds one bit per language. The
bitwise AND of an n-gram's K slots is the mask of all languages that contain it, so one
lookup asks every language. A text's hits are counted per language (popcounts); the hits
that its filter's false-positive rate explains are taken off, and the language with the
most left wins.

Training counts n-grams in Spark over a documented bounded sample of labelled rows
(``SAMPLE_PER_LANG`` rows a language, chosen by a hash of the text); the filters have a
fixed number of slots, so what reaches the driver and the workers is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import CHUNK_BYTES, SEPARATOR, lean, mix64, table, text_chunks

SAMPLE_PER_LANG = 4_000  # rows a language, about
SIZES = (3, 4, 5)        # bytes in an n-gram, blanks included
SLOTS = 1 << 20          # of the filters
PROBES = 2               # hash functions
MIN_COUNT = 3            # an n-gram seen less often in a language's sample is noise
MIN_SHARE = 0.05         # of its highest rate in any language
WORD_BITS = 62           # languages per mask column (a signed long)

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
# bytes that are neither letters nor part of a multi-byte character count as blanks
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_FOLD[SEPARATOR | _PUNCT | (np.arange(256) < 32)] = 32
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (2 * n + 1) & (2**64 - 1)) for n in range(16)]


def _grams(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, row of each) of the n-grams of every size; none crosses a row or starts
    with two blanks."""
    code = _FOLD[buf]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    packed = np.zeros(len(code), np.uint64)
    for n in range(1, max(SIZES) + 1):
        packed = packed[:len(code) - n + 1] << np.uint64(8) | code[n - 1:]
        if n in SIZES and len(packed):
            inside = row[:len(packed)] == row[n - 1:]
            inside &= (code[:len(packed)] != 32) | (code[1:len(packed) + 1] != 32)
            yield mix64(packed[inside] + _SALT[n]), row[:len(packed)][inside]


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    shift = 64 // PROBES
    return [((hashes >> np.uint64(k * shift)) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(PROBES)]


class Model:
    """Languages in code-point order, filter slices (mask columns x slots) and the
    false-positive rate of each language."""

    def __init__(self, langs: list[str], slices: np.ndarray, default: str | None):
        self.langs, self.slices, self.default = langs, slices, default
        fill = [float(((slices[i // WORD_BITS] >> (i % WORD_BITS)) & 1).mean()) for i in range(len(langs))]
        self.false_rate = np.array(fill) ** PROBES

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams per row, and hits per row and language."""
        n = len(offsets) - 1
        total, hits = np.zeros(n), np.zeros((n, len(self.langs)))
        for hashes, row in _grams(buf, offsets):
            total += np.bincount(row, minlength=n)
            slots = _slots(hashes)
            edges = np.searchsorted(row, np.arange(n + 1))
            for word in range(len(self.slices)):
                mask = self.slices[word][slots[0]]
                for s in slots[1:]:
                    mask = mask & self.slices[word][s]
                for i in range(word * WORD_BITS, min(len(self.langs), (word + 1) * WORD_BITS)):
                    ones = np.concatenate(([0], np.cumsum((mask >> (i % WORD_BITS)) & 1)))
                    hits[:, i] += ones[edges[1:]] - ones[edges[:-1]]
        return total, hits

    def predict(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row. The score is the winner's lead over the second
        as a share of its own corrected hits; ties and rows without any hit go to the
        most frequent trained language with score 0."""
        total, hits = self.count(buf, offsets)
        n = len(total)
        if not self.langs:
            return ["und"] * n, np.zeros(n)
        true = np.maximum(0.0, (hits - total[:, None] * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        best = true.argmax(axis=1)
        top = true[np.arange(n), best]
        rest = true.copy()
        rest[np.arange(n), best] = -1
        second = np.maximum(0.0, rest.max(axis=1))
        score = np.where(top > 0, (top - second) / np.maximum(top, 1e-12), 0.0)
        names = [self.langs[b] if s > 0 else self.default for b, s in zip(best, score, strict=True)]
        return names, np.clip(score, 0.0, 1.0)


def train(labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on rows (text, lang). Rows with a null lang or text are left out; no rows at
    all give a model without languages, which answers ``und``."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)  # one entry per language
    if not langs:
        return Model([], np.zeros((0, SLOTS), np.int64), None)
    # keep a row where its text's hash falls under the language's share
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_per_lang / counts[lang]))])
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    sample = rows.where(unit < share[F.col("lang")]).select("text", number[F.col("lang")].alias("lang_no"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("lang_no").to_numpy()
            for chunk in text_chunks(batch.column("text"), CHUNK_BYTES):
                lang_of = numbers[chunk.first:chunk.first + chunk.size].astype(np.uint64)
                for hashes, row in _grams(chunk.buf, chunk.offsets):
                    lang = lang_of[row]
                    for value in np.unique(lang):
                        gram, n = np.unique(hashes[lang == value], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), int(value), np.int32)), pa.array(n)],
                            names=["gram", "lang_no", "n"])

    grams = sample.mapInArrow(lean(count), "gram long, lang_no int, n long").groupBy("gram", "lang_no").agg(F.sum("n").alias("n"))
    sizes = {r["lang_no"]: r["n"] for r in grams.groupBy("lang_no").agg(F.sum("n").alias("n")).collect()}
    total = F.create_map(*[F.lit(x) for i in range(len(langs)) for x in (i, float(max(1, sizes.get(i, 1))))])
    rated = grams.withColumn("rate", F.col("n") / total[F.col("lang_no")])
    per_gram = rated.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang_no", "n", "rate")).alias("in"))
    kept = per_gram.select("gram", "top", F.explode("in").alias("e")).where(
        (F.col("e.n") >= MIN_COUNT) & (F.col("e.rate") >= MIN_SHARE * F.col("top")))
    shift = 64 // PROBES
    probes = F.array(*[(F.shiftrightunsigned("gram", k * shift).bitwiseAND(F.lit(SLOTS - 1))) for k in range(PROBES)])
    words = -(-len(langs) // WORD_BITS)
    bits = kept.select((F.col("e.lang_no") / WORD_BITS).cast("int").alias("word"),
                       F.shiftleft(F.lit(1).cast("long"), 0).alias("one"), (F.col("e.lang_no") % WORD_BITS).alias("bit"),
                       F.explode(probes).alias("slot"))
    bits = bits.withColumn("mask", F.expr("shiftleft(one, bit)"))
    slices = np.zeros((words, SLOTS), np.int64)
    # at most SLOTS rows a mask column, whatever was trained on
    for part in bits.groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow().to_batches():
        slices[part.column("word").to_numpy(), part.column("slot").to_numpy()] = part.column("mask").to_numpy()
    default = min(langs, key=lambda x: (-counts[x], x))
    return Model(langs, slices, default)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(row, lang_pred, score) per row of ``docs``, from its text alone: ``und`` with
    score 0 for a null text or one without a letter, else a trained language. ``row`` is
    the whole input row as a struct, so no column name can clash."""
    row_type = docs.select(F.struct("*").alias("row")).schema["row"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: SLOTS longs a mask column
    rows = docs.select(F.struct("*").alias("row"), F.lower("text").alias("text"), 
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):  # a batch a chunk: neither side holds many whole texts
                own = batch.slice(chunk.first, chunk.size)
                names, score = model.predict(chunk.buf, chunk.offsets)
                letters = own.column("letters").to_pylist()
                names = [name if ok else "und" for name, ok in zip(names, letters, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0), pa.float64())],
                    names=["row", "lang_pred", "score"])

    return rows.mapInArrow(lean(run), T.StructType().add("row", row_type).add("lang_pred", "string").add("score", "double"))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Train on the rows that are not held out and predict all: doc_id, held_out,
    lang_pred, score. A null doc_id is not held out."""
    model = train(docs.where(~held_out()), sample_per_lang)
    found = predict(docs.select("doc_id", "text"), model).select("row.doc_id", "lang_pred", "score")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
