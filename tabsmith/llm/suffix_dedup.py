"""op5: exact repeated-passage removal with a column-wise multi-document suffix order.

A byte is removed when a ``LENGTH``-byte string that covers it also starts in a document
with a smaller id. The work is cut by content so that equal strings meet in one task:

1. Anchors. In every window of LENGTH bytes the GRAM-byte substring with the least hash
   is the anchor; equal windows choose it at the same place. Tasks send anchor hashes to
   hash buckets, which answer which anchors occur in two documents or more. An anchor
   already met in two documents of a task is sent once, and answered on the spot.
2. Segments. Around each shared anchor a document contributes the bytes that any window
   with this anchor can reach. Equal segments of a task's documents are sent once, for
   the smallest id; the others are covered by it entirely.
3. Column-wise construction. A bucket holds a collection of segments, aligned at the
   anchor. Each round inserts one symbol of every segment, from the last column to the
   first: the preceding symbols in the current suffix order are the collection's
   Burrows-Wheeler column, a stable sort by them (the LF mapping) is the next order, and
   a common prefix is one more than the least over the rows between two neighbours with
   the same symbol. Neighbours with a common prefix of LENGTH or more hold the same
   window: all but the smallest document of such a run mark it.
   The sequential external files of the construction are Spark's shuffle files here, one
   stream of packed columns per bucket.
4. The marked spans go back to the documents, which are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import (BYTE_CODE, bucket_count, bucket_runs, lean, mix64, pack, powers, release_shuffles, run_starts, runs,
                                 shared_table, table, text_buffer, text_chunks, unpack)

LENGTH = 50
GRAM = 25
SPAN = LENGTH - GRAM + 1           # anchors' candidates in a window
WIDTH = 2 * LENGTH - GRAM          # bytes of a segment
FLUSH_ANCHORS = 800_000
SEGMENT_ROWS = 30_000
BUCKET_BYTES = 4 << 20             # of the input, an anchor bucket
GROUP_BYTES = 4 << 20              # of the input, a group of documents
_NONE = np.uint64(2**64 - 1)


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position (the largest value never occurs)."""
    n = len(buf)
    if n < GRAM:
        return np.zeros(0, np.uint64)
    power, inverse = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[buf] * power[:n], out=prefix[1:])
    return np.minimum(mix64((prefix[GRAM:] - prefix[:-GRAM]) * inverse[:n - GRAM + 1]), _NONE - np.uint64(1))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``buf`` and hashes of the anchors of all rows. Equal hashes in one
    window are all anchors."""
    n = len(buf)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = _gram_hashes(buf)
    least = _sliding(gram, SPAN, np.minimum)                      # of the window at each position
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    whole = np.arange(len(least)) + LENGTH <= row_end[:len(least)]  # windows within one row
    top = np.where(whole, least, np.uint64(0))
    padded = np.zeros(len(gram) + SPAN - 1, np.uint64)
    padded[SPAN - 1:SPAN - 1 + len(top)] = top
    at = np.flatnonzero(_sliding(padded, SPAN, np.maximum) == gram)  # some whole window chose it
    return at, _spread(gram[at])


def _spread(gram: np.ndarray) -> np.ndarray:
    """Anchors have the least hashes of their windows; hashed again they fill all buckets alike."""
    return mix64(gram ^ np.uint64(0xD6E8FEB86659FD93))


def columnwise_cover(columns: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray,
                     length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the first and last window start (column) that a smaller document
    shares, or (-1, -1). ``columns``: one row per column, one entry per segment (fewer than
    2^31); ``first``/``last``: the window starts that lie within the segment's document."""
    width, m = columns.shape
    order, lcp = np.arange(m, dtype=np.int32), np.zeros(m, np.uint8)
    low, high = np.full(m, -1, np.int16), np.full(m, -1, np.int16)
    for c in range(width - 1, -1, -1):
        bwt = columns[c][order]                                   # symbol before each suffix, in order
        step = np.argsort(bwt, kind="stable").astype(np.int32)    # LF mapping
        symbol = bwt[step]
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        new = np.zeros(m, np.uint8)
        if len(same):
            new[same] = np.minimum(_range_minimum(lcp, step[same - 1] + 1, step[same]), np.uint8(254)) + np.uint8(1)
        order, lcp = order[step], new
        if c <= width - length:
            run = lcp >= length
            if run.any():
                starts = np.flatnonzero(~run)
                inside = (first[order] <= c) & (c <= last[order])
                held = np.where(inside, doc[order], np.iinfo(np.int64).max)
                smallest = np.repeat(np.minimum.reduceat(held, starts), np.diff(np.append(starts, m)))
                hit = order[inside & (held > smallest)]
                high[hit] = np.maximum(high[hit], c)
                low[hit] = c                                      # columns come in falling order
    return low, high


def _range_minimum(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a..b]) for every pair, by a table of minima over powers of two."""
    span = b - a + 1
    level = np.frexp(span.astype(np.float64))[1] - 1              # floor(log2(span))
    out = np.empty(len(a), values.dtype)
    order = np.argsort(level.astype(np.uint8), kind="stable")
    counts = np.bincount(level, minlength=1)
    row, at = values, 0
    for k, n in enumerate(counts):
        if k:
            row = np.minimum(row[:-(1 << (k - 1))], row[1 << (k - 1):])
        if n:
            i = order[at:at + n]
            out[i] = np.minimum(row[a[i]], row[b[i] - (1 << k) + 1])
            at += n
    return out


# ------------------------------------------------------------------ tasks

_MESSAGE = "bucket long, kind int, sender long, size long, blob binary"


def _message(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    """``size``: the number of segments in the blob (0 where it holds none)."""
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
        names=["bucket", "kind", "sender", "size", "blob"])


def _ids(column) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _send_anchors(buckets: int):
    """kind 0: anchors to a hash bucket; kind 1: anchors known to be shared and kind 2: the
    rows' identities, both to the sender's own bucket (below zero)."""
    def flush(sender: int, rows: list, found: list) -> pa.RecordBatch:
        row, pos, gram = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(gram, kind="stable")                   # rows stay ascending within a hash
        row, pos, gram = row[order], pos[order], gram[order]
        starts = run_starts(gram)
        size = np.diff(np.append(starts, len(gram)))
        several = row[starts] != row[starts + size - 1]
        shared = np.repeat(several, size)
        # one entry stands for a hash met in several rows: row number 0, the others from 1
        lone = ~shared
        keep = np.zeros(len(gram), bool)
        keep[lone] = True
        keep[starts[several]] = True
        number = np.where(shared, 0, row + 1)[keep].astype(np.uint32)
        out_pos, out_gram = np.where(shared, 0, pos)[keep].astype(np.uint32), gram[keep]
        out = [(b, 0, sender, 0, pack(np.diff(out_gram[s] >> np.uint64(16), prepend=np.uint64(0)), number[s], out_pos[s]))
               for b, s in bucket_runs(out_gram, buckets)]
        out.append((-1 - sender, 1, sender, 0, pack(row[shared].astype(np.uint32), pos[shared].astype(np.uint32))))
        out.append((-1 - sender, 2, sender, 0, pack(*[np.concatenate(x) for x in zip(*rows, strict=True)])))
        return _message(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, flushed = TaskContext.get().partitionId(), 0
        rows, found, held, n_rows = [], [], 0, 0
        for batch in batches:
            named = [_ids(batch.column(c)) for c in ("doc_id", "digest", "grp")]
            for chunk in text_chunks(batch.column("text"), 1 << 19):
                at, gram = anchors(chunk.buf, chunk.offsets)
                local = np.searchsorted(chunk.offsets, at, "right") - 1
                rows.append([x[chunk.first:chunk.first + chunk.size] for x in named])
                found.append((local + n_rows, at - chunk.offsets[local], gram))
                n_rows += chunk.size
                held += len(at)
                if held >= FLUSH_ANCHORS:
                    yield flush((task << 20) + flushed, rows, found)
                    rows, found, held, n_rows, flushed = [], [], 0, 0, flushed + 1
        if rows:
            yield flush((task << 20) + flushed, rows, found)

    return run


def _answer_anchors(blobs: pa.Table) -> pa.Table:
    """A bucket's shared anchors, back to their senders; other kinds pass through."""
    kinds = blobs.column("kind").to_numpy()
    if kinds[0] != 0:
        return blobs
    senders = blobs.column("sender").to_numpy()
    parts = [unpack(b.as_py()) for b in blobs.column("blob")]
    gram = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    number, pos = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    part = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(gram, kind="stable")
    gram, number, pos, part = gram[order], number[order], pos[order], part[order]
    starts = run_starts(gram)
    size = np.diff(np.append(starts, len(gram)))
    who = part.astype(np.int64) << 32 | number
    last = starts + size - 1
    several = (np.minimum.reduceat(who, starts) != np.maximum.reduceat(who, starts)) | (number[last] == 0) | (number[starts] == 0) \
        if len(starts) else np.zeros(0, bool)
    hit = np.repeat(several, size) & (number > 0)
    i = np.flatnonzero(hit)
    i = i[np.argsort(part[i], kind="stable")]
    edges = np.searchsorted(part[i], np.arange(len(parts) + 1))
    rows = [(-1 - int(senders[p]), 1, int(senders[p]), 0, pack(number[i[a:b]] - np.uint32(1), pos[i[a:b]]))
            for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
    return pa.Table.from_batches([_message(rows)])


def _to_groups(blobs: pa.Table) -> pa.Table:
    """A sender's shared anchors, named by (doc_id, digest) instead of row number, dealt
    to document groups."""
    found = []
    for kind, blob in zip(blobs.column("kind").to_pylist(), blobs.column("blob"), strict=True):
        parts = unpack(blob.as_py())
        if kind == 2:
            ids, digests, group_of = parts
        else:
            found.append(parts)
    row, pos = (np.concatenate([p[i] for p in found]) for i in (0, 1))
    group = group_of[row]
    order = np.lexsort((pos, row, group))
    group, row, pos = group[order], row[order], pos[order]
    out = []
    for g, a, b in runs(group):
        own, index = np.unique(row[a:b], return_inverse=True)
        out.append((g, pack(ids[own], digests[own], index.astype(np.uint32), pos[a:b])))
    return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["grp", "blob"])


class _Group:
    """The distinct documents of a group in (doc_id, digest) order; rows that repeat both
    share one document."""

    def __init__(self, docs: pa.Table):
        docs = docs.combine_chunks()
        self.null = docs.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        ids, digests = (_ids(docs.column(n).combine_chunks()) for n in ("doc_id", "digest"))
        column = docs.column("text").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        self.buf, self.offsets = text_buffer(column)
        order = np.lexsort((digests, ids, self.null))
        new = np.ones(len(order), bool)
        if len(order) > 1:
            a, b = order[1:], order[:-1]
            new[1:] = (ids[a] != ids[b]) | (digests[a] != digests[b]) | (self.null[a] != self.null[b])
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.row = order[new]                       # a table row of each document
        self.ids, self.digests = ids[self.row], digests[self.row]
        # documents without an id come last and take no part
        self.n = int((~self.null[self.row]).sum())

    def find(self, ids: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """Document numbers of (id, digest) pairs, -1 where there is none."""
        at = np.searchsorted(self.ids[:self.n], ids)
        out = np.full(len(ids), -1, np.int64)
        for i, k in enumerate(at):
            while k < self.n and self.ids[k] == ids[i]:
                if self.digests[k] == digests[i]:
                    out[i] = k
                    break
                k += 1
        return out


def _send_segments(buckets: int):
    """kind 0: segments around shared anchors to a hash bucket; kind 1: spans already
    covered by a smaller document of the same group."""
    def run(key, docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return pa.Table.from_batches([_message([])])
        group = _Group(docs)
        doc, pos = [], []
        for blob in shared.column("blob"):
            ids, digests, index, at = unpack(blob.as_py())
            number = group.find(ids, digests)[index]
            doc.append(number[number >= 0])
            pos.append(at[number >= 0].astype(np.int64))
        doc, pos = np.concatenate(doc), np.concatenate(pos)
        start = group.offsets[group.row[doc]]
        size = group.offsets[group.row[doc] + 1] - start
        padded = np.concatenate((np.zeros(WIDTH, np.uint8), group.buf, np.zeros(WIDTH, np.uint8)))
        view = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)
        out, resolved = [], []
        for a in range(0, len(doc), SEGMENT_ROWS):  # bounds the memory of the segment matrix
            d, p, s, n = doc[a:a + SEGMENT_ROWS], pos[a:a + SEGMENT_ROWS], start[a:a + SEGMENT_ROWS], size[a:a + SEGMENT_ROWS]
            matrix = view[s + p + WIDTH - (SPAN - 1)].copy()
            column = p[:, None] - (SPAN - 1) + np.arange(WIDTH)
            matrix[(column < 0) | (column >= n[:, None])] = 0
            first = np.maximum(0, SPAN - 1 - p)
            last = np.minimum(SPAN - 1, n - LENGTH - p + SPAN - 1)
            codes = BYTE_CODE[matrix]
            power, _ = powers(WIDTH + 1)
            whole = mix64((codes * power[:WIDTH]).sum(axis=1, dtype=np.uint64) + (first * 64 + last).astype(np.uint64))
            gram = _spread(mix64((codes[:, SPAN - 1:LENGTH] * power[:GRAM]).sum(axis=1, dtype=np.uint64)))
            order = np.lexsort((d, whole, gram))
            run_of = run_starts(whole[order])
            count = np.diff(np.append(run_of, len(order)))
            same = np.repeat(order[run_of], count)  # the smallest document with this segment
            if not (matrix[same] == matrix[order]).all():
                same = order                        # a hash collision: send every segment
            covered = group.ids[d[order]] > group.ids[d[same]]
            i = order[covered]
            resolved.append((d[i], p[i] - (SPAN - 1) + first[i], p[i] - (SPAN - 1) + last[i] + LENGTH))
            i = order[~covered]
            for b, s_ in bucket_runs(gram[i], buckets):
                j = i[s_]
                own, index = np.unique(d[j], return_inverse=True)
                out.append((b, 0, int(key[0].as_py()), len(j), pack(
                    matrix[j].reshape(-1), own.astype(np.uint32), np.diff(group.ids[own], prepend=0).astype(np.int64),
                    index.astype(np.uint32), p[j].astype(np.uint32), first[j].astype(np.uint8), last[j].astype(np.uint8))))
        spans = [np.concatenate(x).astype(np.uint32) for x in zip(*resolved, strict=True)]
        out.append((-1 - int(key[0].as_py()), 1, int(key[0].as_py()), 0, pack(*spans)))
        return pa.Table.from_batches([_message(out)])

    return run


def _cover_segments(blobs: pa.Table) -> pa.Table:
    """The column-wise construction over one bucket; spans by document group."""
    groups = blobs.column("sender").to_numpy()
    if blobs.column("kind")[0].as_py() != 0:
        return pa.table([pa.array(groups, pa.int64()), blobs.column("blob")], names=["grp", "blob"])
    sizes = blobs.column("size").to_numpy()
    edges = np.concatenate(([0], np.cumsum(sizes)))
    m = int(edges[-1])
    # one array of each kind for the whole bucket; a blob's arrays go as soon as they are copied
    columns, doc = np.empty((WIDTH, m), np.uint8), np.empty(m, np.int64)
    number, pos = np.empty(m, np.uint32), np.empty(m, np.uint32)
    first, last = np.empty(m, np.uint8), np.empty(m, np.uint8)
    for k, blob in enumerate(blobs.column("blob")):
        s = slice(edges[k], edges[k + 1])
        symbols, own, ids, index, pos[s], first[s], last[s] = unpack(blob.as_py())
        columns[:, s] = symbols.reshape(-1, WIDTH).T
        doc[s], number[s] = np.cumsum(ids)[index], own[index]
        del symbols
    low, high = columnwise_cover(columns, doc, first, last)
    del columns
    out = []
    i = np.flatnonzero(low >= 0)
    ends = np.searchsorted(i, edges)
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if b > a:
            j = i[a:b]
            begin = pos[j].astype(np.int64) - (SPAN - 1)
            out.append((int(groups[k]), pack(number[j], (begin + low[j]).astype(np.uint32), (begin + high[j] + LENGTH).astype(np.uint32))))
    return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["grp", "blob"])


def _cut(with_text: bool):
    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        group = _Group(docs)
        gone = np.zeros(len(group.buf) + 1, np.int32)
        for blob in spans.column("blob"):
            number, a, b = unpack(blob.as_py())
            start = group.offsets[group.row[number]]
            np.add.at(gone, start + a, 1)
            np.add.at(gone, start + b, -1)
        np.cumsum(gone, dtype=np.int32, out=gone)
        gone = gone[:-1] > 0
        n_bytes, n_removed, n_spans, digest, text = [], [], [], [], []
        done: dict[int, tuple] = {}
        for number in group.number.tolist():
            if number not in done:
                r = group.row[number]
                a, b = int(group.offsets[r]), int(group.offsets[r + 1])
                cut = gone[a:b]
                kept = group.buf[a:b][~cut].tobytes() if cut.any() else group.buf[a:b].tobytes()
                runs = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum()) if len(cut) else 0
                done[number] = (b - a, int(cut.sum()), runs, hashlib.sha256(kept).hexdigest(),
                                kept.decode("utf-8", "ignore") if with_text else None)
            for column, value in zip((n_bytes, n_removed, n_spans, digest, text), done[number], strict=True):
                column.append(value)
        ids = docs.column("doc_id")
        cols = [ids, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                pa.array(digest, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            cols += [pa.array(text, pa.string()), docs.column("row")]
            names += ["kept_text", "row"]
        return pa.table(cols, names=names)

    return run


def remove_repeats(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256. With ``keep_rows`` also
    kept_text (bytes of a character that was cut in part are left out) and row, a struct
    of all other columns of ``docs``.

    A null text counts as empty. Rows with equal doc_id never remove from one another (the
    id must be smaller); a row without doc_id neither removes nor loses anything. Rows that
    repeat id and text get the same result. An empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    buckets = bucket_count(docs.select("text"), BUCKET_BYTES, 32)
    groups = bucket_count(docs.select("text"), GROUP_BYTES, 8)
    extra = [F.struct(*[f"`{c}`" for c in docs.columns if c != "text"]).alias("row")] if keep_rows else []
    digest = F.xxhash64("text")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("digest"),
                        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), digest), F.lit(groups)).alias("grp"), *extra)
    rows = whole.select("doc_id", "text", "digest", "grp")

    sent = rows.mapInArrow(lean(_send_anchors(buckets)), _MESSAGE)
    answered = sent.groupBy("bucket").applyInArrow(lean(_answer_anchors), _MESSAGE)
    shared = shared_table(answered.groupBy("bucket").applyInArrow(lean(_to_groups), "grp long, blob binary"), "anchors", spark)
    del sent, answered
    release_shuffles(spark)

    segments = rows.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(lean(_send_segments(buckets)), _MESSAGE)
    spans = shared_table(segments.groupBy("bucket").applyInArrow(lean(_cover_segments), "grp long, blob binary"), "spans", spark)
    del segments
    release_shuffles(spark)

    schema = T.StructType().add("doc_id", "long")
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema.add(name, "long")
    schema.add("kept_sha256", "string")
    if keep_rows:
        schema.add("kept_text", "string").add("row", whole.schema["row"].dataType)
    out = whole.groupBy("grp").cogroup(spans.groupBy("grp")).applyInArrow(lean(_cut(keep_rows)), schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


# The rule itself: every window of every text (named by its 64-bit hash), then islands of
# overlapping hits.
SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, greatest(0, octet_length(h) - 49))) AS p, h FROM d),
v AS (SELECT doc_id, p, hash(h[p + 1:p + 50]) AS k FROM w),
m AS (SELECT k, min(doc_id) AS least FROM v GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT DISTINCT doc_id, p FROM v JOIN m USING (k) WHERE least < doc_id),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS new FROM hit),
i AS (SELECT doc_id, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS n, p FROM g),
s AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, n),
e AS (SELECT s.*, lag(b, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY a) AS b0, hex(h) AS x, octet_length(h) AS size FROM s JOIN d USING (doc_id)),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
    string_agg(x[2 * b0 + 1:2 * a], '' ORDER BY a) || any_value(x[2 * last_b + 1:2 * size]) AS kept
    FROM (SELECT *, max(b) OVER (PARTITION BY doc_id) AS last_b FROM e) GROUP BY doc_id)
SELECT d.doc_id, octet_length(d.h) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, hex(d.h)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
