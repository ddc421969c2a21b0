"""Helpers shared by the corpus operators: Arrow text buffers, word and n-gram hashes,
packed integer blobs and the shared folder.

Operators that move hundreds of millions of small integers send them as packed blobs
(one row per task and bucket) instead of one row per integer: Spark partitions,
shuffles and retries the blobs, numpy works on whole arrays inside each task.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
import os
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import ensure_checkpoint_dir

CHUNK_BYTES = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

# [\x20\x09-\x0D] separates words in every operator of this package
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20260101))
BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_CODE = BYTE_CODE[LOWER]
# multipliers of the places in a shingle; unrelated, so that no exchange of words cancels out
PLACE_CODE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_bytes(df: DataFrame) -> int:
    """Size estimate of the optimised plan (file sizes for a scan); no job runs."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def bucket_count(df: DataFrame, bytes_per_bucket: int = 4 << 20, least: int = 16, most: int = 1 << 32) -> int:
    """Buckets for a packed shuffle: in proportion to the input, so a bucket's size stays bounded
    (``most``: where :func:`bucket_of` ends, some 10^16 bytes of input)."""
    size = input_bytes(df)
    if not size:
        size = bytes_per_bucket * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return int(max(least, min(most, size // bytes_per_bucket)))


def shared_table(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: the lineage ends
    there, a lost executor re-reads files, and the shuffles before it can be released."""
    spark = spark or df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark's cleaner removes shuffle files of
    finished stages now instead of at its next periodic collection."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ------------------------------------------------------------------ memory of the workers

def give_back() -> None:
    """Return memory that is free, but held by Arrow's and the C library's allocators, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """A function of mapInArrow or applyInArrow that gives free memory back. Python workers
    are reused: what a task's arrays took would stay in each of them, beside the next
    task's own and the executor's heap."""
    if inspect.isgeneratorfunction(work):
        @functools.wraps(work)
        def run(*args):
            give_back()
            yield from work(*args)
            give_back()
    else:
        @functools.wraps(work)
        def run(*args):
            out = work(*args)
            give_back()
            return out
    run.__signature__ = inspect.signature(work)  # Spark counts the arguments
    return run


# ------------------------------------------------------------------ hashing

def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of ``codes`` (per-byte codes), by prefix sums."""
    power, inverse = powers(len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:-1], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Chunk:
    """Some consecutive rows of a batch: ids, one byte buffer, and offsets into it."""

    __slots__ = ("buf", "first", "offsets", "size")

    def __init__(self, first: int, buf: np.ndarray, offsets: np.ndarray):
        self.first, self.buf, self.offsets, self.size = first, buf, offsets, len(offsets) - 1


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a column into runs of rows of about ``limit`` bytes (at least one row each)."""
    buf, offsets = text_buffer(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Chunk(row, buf[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and the word count of each row."""
    sep = SEPARATOR[chunk.buf]
    n = len(sep)
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    before = np.ones(n + 1, bool)
    before[1:] = sep
    after = np.ones(n + 1, bool)
    after[:n] = sep
    word = ~sep
    starts = np.flatnonzero(word & (before[:n] | edge[:n]))
    ends = np.flatnonzero(word & (after[1:] | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, chunk.offsets))
    return starts, ends, counts


def word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lowered) in order, and the word count of each row."""
    starts, ends, counts = word_spans(chunk)
    return span_hashes(LOWER_CODE[chunk.buf], starts, ends), counts


def shingle_sets(chunk: Chunk, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its ``words``-word shingles). A row with fewer
    words has its whole sequence as one shingle; a row without words an empty set."""
    hashes, counts = word_hashes(chunk)
    salt = PLACE_CODE[:words]
    total = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        total += hashes[k:len(total) + k] * salt[k]
    total = mix64(total)
    first = np.concatenate(([0], np.cumsum(counts)))
    for row in range(chunk.size):
        a, n = int(first[row]), int(counts[row])
        if n >= words:
            yield row, np.unique(total[a:a + n - words + 1])
        elif n:
            short = np.uint64(n)
            for k in range(n):
                short = short + hashes[a + k:a + k + 1] * salt[k]
            yield row, mix64(short)
        else:
            yield row, hashes[:0]


# ------------------------------------------------------------------ packed blobs

def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Integer arrays as one compressed blob: byte planes, leading zero planes left out."""
    parts = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        width = a.dtype.itemsize
        planes = a.view(np.uint8).reshape(-1, width).T
        keep = width
        if a.dtype.kind != "u":
            pass
        else:
            top = int(a.max()) if len(a) else 0
            keep = max(1, (top.bit_length() + 7) // 8)
        parts.append(struct.pack("<8sQH", a.dtype.str.encode(), len(a), keep))
        parts.append(np.ascontiguousarray(planes[:keep]).tobytes())
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (count,), at, out = struct.unpack_from("<H", raw), 2, []
    for _ in range(count):
        kind, n, keep = struct.unpack_from("<8sQH", raw, at)
        at += struct.calcsize("<8sQH")
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        planes = np.frombuffer(raw, np.uint8, n * keep, at).reshape(keep, n)
        at += n * keep
        full = np.zeros((n, dtype.itemsize), np.uint8)
        full[:, :keep] = planes.T
        out.append(full.reshape(-1).view(dtype))
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the leading bits: monotone in the hash, so sorted hashes fall in runs."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def bucket_runs(sorted_hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of each non-empty run of sorted hashes."""
    for b, i, j in runs(bucket_of(sorted_hashes, buckets)):
        yield b, slice(i, j)


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first element of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1))


def runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    starts = run_starts(sorted_values).tolist()
    for a, b in zip(starts, [*starts[1:], len(sorted_values)]):  # noqa: B905 - no run, no pair
        yield int(sorted_values[a]), a, b


def local_path(uri: str) -> str | None:
    """The path of a mounted (file:) folder; None for a store that has no mount."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") and "://" not in uri else None


def word_count(text) -> F.Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def ensure_dir(path: str) -> None:
    os.makedirs(path, exist_ok=True)
