"""op9: interpolated modified Kneser-Ney bigram model, counted in Spark, scored from
memory-mapped sorted hash arrays.

Counting: every task hashes its words, counts its own word pairs and sends them as packed
blobs to buckets of pair hashes (a pair met a million times in a task is one entry).
A bucket merges the counts, writes one file of sorted 64-bit entries (48 hash bits that
its bucket number does not imply, 16 bits of count) and passes on, per word, what the
model needs: count, left extensions, followers seen once, twice and more. Those go to
word buckets, which write their sorted arrays the same way. Files are written under a
temporary name and renamed, so a task that runs again leaves the same file.

Scoring: workers map the files read-only, sort a block's lookups by bucket and hash, and
walk each file in order. The folder must be mounted on every worker (it is made under
``spark.checkpoint.dir``). Nothing is pruned: the model grows with the corpus.

p(w|u) = (max(c(uw) - D(c(uw)), 0) + (D1 N1(u) + D2 N2(u) + D3 N3+(u)) q(w)) / c(u)
q(w)   = (max(l(w) - D'(l(w)), 0) + (D1' M1 + D2' M2 + D3' M3+) / (V + 1)) / L
with l(w) the number of different words before w, L their sum, M the number of words
with l = 1, 2, 3 or more, and discounts D, D' from the counts of counts.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm.common import (bucket_count, local_path, mix64, pack, run_starts, runs, table, text_chunks, unpack,
                                 word_hashes)
from tabsmith.session import ensure_checkpoint_dir

FLUSH_TOKENS = 3_000_000   # tokens a task counts before it sends a blob
SCORE_TOKENS = 800_000     # tokens looked up at a time
BUCKET_BYTES = 4 << 20     # of the input, a bucket of pairs
END, BEGIN = np.uint64(1), np.uint64(2)
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_16 = np.uint64(16)
_FULL = 0xFFFF             # a count that does not fit; its value is in the overflow arrays
WORD_FIELDS = ("count", "lefts", "follows", "once", "twice", "more")


def _words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(previous, current, tokens per row) for each run of rows: 48-bit word hashes, an
    end after each row's words, a begin before them."""
    for chunk in text_chunks(column):
        hashes, counts = word_hashes(chunk)
        n = len(counts)
        ends = np.cumsum(counts) + np.arange(n)
        current = np.full(len(hashes) + n, END, np.uint64)
        inner = np.ones(len(current), bool)
        inner[ends] = False
        current[inner] = np.maximum(hashes >> _16, np.uint64(3))
        previous = np.empty_like(current)
        previous[1:] = current[:-1]
        previous[0] = BEGIN
        previous[ends[:-1] + 1] = BEGIN
        yield previous, current, counts + 1


def _pair_key(previous: np.ndarray, current: np.ndarray) -> np.ndarray:
    return mix64(previous * _A + current * _B)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """From the low 16 bits, so that the sorted high bits stay independent of the bucket."""
    return ((key & np.uint64(0xFFFF)) * np.uint64(buckets)) >> _16


def _word_bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket(word, buckets)


def _runs(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    for b, i, j in runs(bucket):
        yield b, slice(i, j)


def _merge(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct sorted keys, the first row of each, and each value array summed per key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = run_starts(keys)
    summed = [np.add.reduceat(v[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64) for v in values]
    return [keys[starts], order[starts], *summed]


def _save(folder: str, name: str, *arrays: np.ndarray) -> None:
    """One file a name: raw arrays, written aside and renamed."""
    for i, a in enumerate(arrays):
        aside = os.path.join(folder, f".{name}-{i}-{uuid.uuid4().hex}")
        with open(aside, "wb") as f:
            np.save(f, a)
        os.replace(aside, os.path.join(folder, f"{name}-{i}.npy"))


def _load(folder: str, name: str, arrays: int) -> list[np.ndarray] | None:
    if not os.path.exists(os.path.join(folder, f"{name}-0.npy")):
        return None
    return [np.load(os.path.join(folder, f"{name}-{i}.npy"), mmap_mode="r") for i in range(arrays)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; where a count is missing
    (tiny corpora) half of the counted number."""
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate((d1, d2, d3), 1))


class Model:
    """Where the files are, bucket numbers and the totals; small and sent to workers."""

    def __init__(self, folder: str, pair_buckets: int, word_buckets: int, totals: dict[str, int]):
        self.folder, self.pair_buckets, self.word_buckets, self.full = folder, pair_buckets, word_buckets, _FULL
        self.tokens, self.vocabulary, self.lefts = totals["tokens"], totals["vocabulary"], totals["lefts"]
        self.d = discounts(*(totals[f"pairs{k}"] for k in range(1, 5)))
        self.d_left = discounts(*(totals[f"lefts{k}"] for k in range(1, 5)))
        spread = sum(d * totals[k] for d, k in zip(self.d_left, ("lefts1", "lefts2", "lefts3up"), strict=True))
        self.floor = (spread / self.lefts if self.lefts else 1.0) / (self.vocabulary + 1)


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """Count all rows of ``docs`` (text) and write the model's files. A null or empty text
    is one end. No rows give an empty model (every score is then 0)."""
    spark = docs.sparkSession
    uri = folder or f"{ensure_checkpoint_dir(spark)}/kneser-ney-{uuid.uuid4().hex}"
    path = local_path(uri)
    if path is None:
        raise ValueError(f"the model folder must be mounted on driver and workers, not {uri}")
    os.makedirs(path, exist_ok=True)
    pair_buckets = min(1 << 16, bucket_count(docs, BUCKET_BYTES))
    word_buckets = max(4, pair_buckets // 8)

    def flush(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        previous, current = (np.concatenate(x) for x in zip(*pairs, strict=True))
        key = _pair_key(previous, current)
        order = np.argsort(key)
        starts = run_starts(key[order])
        count = np.diff(np.append(starts, len(key))).astype(np.uint32)
        first = order[starts]
        bucket = _bucket(key[first], pair_buckets)
        again = np.argsort(bucket << np.uint64(48) | previous[first])
        first, count, bucket = first[again], count[again], bucket[again]
        rows = [(b, pack(np.diff(previous[first[s]], prepend=np.uint64(0)), current[first[s]], count[s])) for b, s in _runs(bucket)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                          names=["bucket", "blob"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held = [], 0
        for batch in batches:
            for previous, current, _ in _words(batch.column("text")):
                pairs.append((previous, current))
                held += len(current)
                if held >= FLUSH_TOKENS:
                    yield flush(pairs)
                    pairs, held = [], 0
        if pairs:
            yield flush(pairs)

    def merge_pairs(blobs: pa.Table) -> pa.Table:
        bucket = blobs.column("bucket")[0].as_py()
        parts = [unpack(b.as_py()) for b in blobs.column("blob")]
        previous = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        current, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        key, first, total = _merge(_pair_key(previous, current), n)
        previous, current = previous[first], current[first]
        big = total >= _FULL
        entry = key >> _16 << _16 | np.where(big, _FULL, total).astype(np.uint64)
        _save(path, f"pairs-{bucket}", entry, key[big], total[big])
        # what each word gets from this bucket's pairs
        zero = np.zeros(len(total), np.int64)
        one = zero + 1
        both = np.concatenate((current, previous))
        fields = [np.concatenate(x) for x in ((total, zero), (one, zero), (zero, total), (zero, total == 1),
                                              (zero, total == 2), (zero, total > 2))]
        word, _, *sums = _merge(both, *fields)
        to = _word_bucket(word, word_buckets)
        order = np.argsort(to, kind="stable")
        rows = [(b, pack(np.diff(word[order[s]], prepend=np.uint64(0)), *[f[order[s]].astype(np.uint64) for f in sums]))
                for b, s in _runs(to[order])]
        rows.append((-1, pack(np.array([(total == k).sum() for k in range(1, 5)], np.uint64))))
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])

    names = ["tokens", "vocabulary", "lefts", "lefts1", "lefts2", "lefts3", "lefts4", "lefts3up"] + [f"pairs{k}" for k in range(1, 5)]

    def merge_words(blobs: pa.Table) -> pa.Table:
        bucket = blobs.column("bucket")[0].as_py()
        parts = [unpack(b.as_py()) for b in blobs.column("blob")]
        values = dict.fromkeys(names, 0)
        if bucket < 0:
            for k in range(4):
                values[f"pairs{k + 1}"] = int(sum(int(p[0][k]) for p in parts))
        else:
            word, _, *sums = _merge(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]),
                                    *[np.concatenate([p[i + 1] for p in parts]) for i in range(len(WORD_FIELDS))])
            widest = max((int(s.max()) for s in sums), default=0)
            fields = np.stack(sums, axis=1).astype(np.uint32 if widest < 1 << 32 else np.uint64)
            _save(path, f"words-{bucket}", word, fields)
            counts, lefts = sums[0], sums[1]
            values |= {"tokens": int(counts.sum()), "vocabulary": int((counts > 0).sum()), "lefts": int(lefts.sum()),
                       "lefts3up": int((lefts > 2).sum())} | {f"lefts{k}": int((lefts == k).sum()) for k in range(1, 5)}
        return pa.table([pa.array([values[n]], pa.int64()) for n in names], names=names)

    sent = docs.select("text").mapInArrow(count, "bucket int, blob binary")
    merged = sent.groupBy("bucket").applyInArrow(merge_pairs, "bucket int, blob binary")
    totals = merged.groupBy("bucket").applyInArrow(merge_words, ", ".join(f"{n} long" for n in names))
    row = totals.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return Model(path, pair_buckets, word_buckets, row.asDict())


class _Reader:
    def __init__(self, model: Model):
        self.model, self._files = model, {}

    def _file(self, name: str, arrays: int):
        if name not in self._files:
            self._files[name] = _load(self.model.folder, name, arrays)
        return self._files[name]

    def words(self, word: np.ndarray) -> np.ndarray:
        """WORD_FIELDS of each word, zeros for a word that was not met."""
        out = np.zeros((len(word), len(WORD_FIELDS)), np.int64)
        bucket = _word_bucket(word, self.model.word_buckets).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        for b, s in _runs(bucket[order]):
            if (file := self._file(f"words-{b}", 2)) is None:
                continue
            at = order[s]
            hit = np.minimum(np.searchsorted(file[0], word[at]), len(file[0]) - 1)
            found = file[0][hit] == word[at]
            out[at[found]] = file[1][hit[found]]
        return out

    def pairs(self, previous: np.ndarray, current: np.ndarray) -> np.ndarray:
        key = _pair_key(previous, current)
        out = np.zeros(len(key), np.int64)
        order = np.argsort(key)
        order = order[np.argsort(_bucket(key[order], self.model.pair_buckets).astype(np.uint16), kind="stable")]
        for b, s in _runs(_bucket(key[order], self.model.pair_buckets)):
            if (file := self._file(f"pairs-{b}", 3)) is None:
                continue
            at = order[s]
            high = key[at] >> _16 << _16
            hit = np.minimum(np.searchsorted(file[0], high), len(file[0]) - 1)
            entry = file[0][hit]
            count = np.where(entry >> _16 << _16 == high, entry & np.uint64(0xFFFF), np.uint64(0)).astype(np.int64)
            for i in np.flatnonzero(count == self.model.full):
                j = int(np.searchsorted(file[1], key[at[i]]))
                count[i] = int(file[2][j]) if j < len(file[1]) and file[1][j] == key[at[i]] else 0
            out[at] = count
        return out

    def score(self, previous: np.ndarray, current: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability, log10 base probability and training count of each token."""
        m = self.model
        distinct, inverse = np.unique(np.concatenate((current, previous)), return_inverse=True)
        fields = self.words(distinct)
        n = len(current)
        lefts = fields[:, 1]
        off = np.array([0.0, *m.d_left])[np.minimum(lefts, 3)]
        lower = (lefts - off) / max(1, m.lefts) + m.floor
        spread = fields[:, 3:] @ np.array(m.d)
        follows = fields[:, 2]
        pair = self.pairs(previous, current)
        pair_off = np.array([0.0, *m.d])[np.minimum(pair, 3)]
        q = lower[inverse[:n]]
        total = follows[inverse[n:]]
        p = np.where(total > 0, (np.maximum(pair - pair_off, 0.0) + spread[inverse[n:]] * q) / np.maximum(total, 1), q)
        count = fields[:, 0][inverse[:n]]
        base = np.log10((count + 1) / (m.tokens + 1 * (m.vocabulary + 1)))
        return np.log10(p), base, count


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity
    (10 to the mean negative score). A null or empty text is one end token."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model)

        def block(parts):
            previous, current, tokens = (np.concatenate(x) for x in zip(*parts, strict=True))
            starts = np.concatenate(([0], np.cumsum(tokens)[:-1]))
            logp, base, count = reader.score(previous, current)
            return tokens, *(np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), base, logp))

        for batch in batches:
            parts, held, done = [], 0, []
            for part in _words(batch.column("text")):
                parts.append(part)
                held += len(part[1])
                if held >= SCORE_TOKENS:
                    done.append(block(parts))
                    parts, held = [], 0
            if parts:
                done.append(block(parts))
            tokens, known, base, logp = (np.concatenate(x) for x in zip(*done, strict=True)) if done else [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)),
                 pa.array(np.full(len(tokens), model.tokens, np.int64)), pa.array(base.astype(np.float64)),
                 pa.array(logp.astype(np.float64)), pa.array(10 ** (-logp / np.maximum(tokens, 1)).astype(np.float64))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                     "base_score", "score", "perplexity")
