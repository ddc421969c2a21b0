"""op6: quality rules by compression bands.

The zstandard ratio (compressed / plain bytes) of natural text lies in a band that
depends on its length: short texts carry the frame and have seen little context, long
ones have settled. Text below its band repeats itself, text above it is noise. The band
is tested on the whole text and, for texts of more than a chunk, on fixed chunks to the
last byte, so that a long document that is only partly repetitive or random is caught too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm.common import BYTE_CODE, SEPARATOR, mix64, span_hashes, table, text_chunks, word_spans

LEVEL = 3
# (from this many bytes on, lowest ratio, highest ratio) of a whole text
BANDS = [(0, 0.0, 8.0), (100, 0.20, 1.30), (256, 0.25, 0.92), (1024, 0.22, 0.80), (4096, 0.20, 0.72), (16384, 0.15, 0.68)]
CHUNK = 4096          # fixed chunk; a shorter last piece has the limits of its length
CHUNK_BAND = (0.12, 0.75)
MAX_BAD_CHUNKS = 0.2  # share of chunks (by bytes) that may lie outside
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80  # not a UTF-8 continuation byte
_SALT = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def band_of(n_bytes: int) -> tuple[float, float]:
    low, high = 0.0, 8.0
    for least, a, b in BANDS:
        if n_bytes >= least:
            low, high = a, b
    return low, high


def _within(ratio: float, band: tuple[float, float]) -> bool:
    return band[0] <= ratio <= band[1]


class _Ratio:
    def __init__(self):
        self._compress = zstandard.ZstdCompressor(level=LEVEL).compress

    def __call__(self, raw) -> float:
        return len(self._compress(raw)) / len(raw)


def judge(raw: bytes, ratio: _Ratio) -> tuple[float | None, int, int, bool]:
    """(whole ratio, chunks judged, chunks outside their band, verdict) of one text.
    An empty text has no ratio and is rejected."""
    if not raw:
        return None, 0, 0, False
    whole = ratio(raw)
    low, high = band_of(len(raw))
    chunks = bad = bad_bytes = 0
    if len(raw) > CHUNK:
        for at in range(0, len(raw), CHUNK):
            piece = raw[at:at + CHUNK]
            outside = not _within(ratio(piece), CHUNK_BAND if len(piece) == CHUNK else band_of(len(piece)))
            if CHUNK // 2 <= len(piece) < CHUNK:  # the tail is most of a chunk: the last full one too
                outside = outside or not _within(ratio(raw[-CHUNK:]), CHUNK_BAND)
            chunks += 1
            bad += outside
            bad_bytes += len(piece) * outside
    return whole, chunks, bad, low <= whole <= high and bad_bytes <= MAX_BAD_CHUNKS * len(raw)


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    if len(hashes) < 4:
        return 0
    window = mix64(hashes[:-2] * _SALT[0] + hashes[1:-1] * _SALT[1] + hashes[2:] * _SALT[2])
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    if len(counts) == len(window):
        return 0
    twice = counts[inverse] > 1
    covered = np.zeros(len(hashes), bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio, n_chunks, n_bad_chunks.

    A null or empty text has zero counts, fails the base (fewer than 50 words) and has a
    null ratio. Rows are judged one by one; repeats and null ids need no special case.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = _Ratio()
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for chunk in text_chunks(batch.column("text")):
                starts, ends, counts = word_spans(chunk)
                hashes = span_hashes(BYTE_CODE[chunk.buf], starts, ends)
                first = np.concatenate(([0], np.cumsum(counts)))
                sums = [np.concatenate(([0], np.cumsum(flag, dtype=np.int64))) for flag in
                        (_HEAD[chunk.buf] & ~SEPARATOR[chunk.buf], _SYMBOL[chunk.buf])]
                for row in range(chunk.size):
                    a, b = int(chunk.offsets[row]), int(chunk.offsets[row + 1])
                    raw = chunk.buf[a:b].tobytes()
                    n_words = int(counts[row])
                    repeats = repeated_words(hashes[first[row]:first[row + 1]])
                    failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n_words
                    whole, chunks, bad, good = judge(raw, ratio)
                    values = (n_words, int(sums[0][b] - sums[0][a]), int(sums[1][b] - sums[1][a]),
                              duplicate_lines(raw.decode()), repeats, failed, good and not failed, whole, chunks, bad)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v, k) for v, k in zip(out, kinds, strict=True)]],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks"])

    return docs.select("doc_id", "text").mapInArrow(
        rules, f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
