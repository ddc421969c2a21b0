"""op8: exact Jaccard join on 5-word shingles by vertical partitioning.

The shingles of all documents are one ordered universe, cut into fragments. A document
is the union of its segments, one a fragment; every overlap is the sum of what the
fragments count on their own.

1. Fragments count in how many documents each shingle occurs and answer each document's
   shared shingles. Summed per document this bounds any overlap: a document with less
   than 80% shared shingles links with nothing. Documents with equal sets are one class.
2. The shingles of the remaining classes are ordered by document frequency, then hash.
   Linked sets share one of their first n - ceil(0.8 n) + 1 shingles (prefix filter), so
   the classes that share a prefix shingle are a candidate group; the place of the shingle
   in each set bounds what can follow it (positional filter).
3. Candidate pairs are counted fragment by fragment and summed per pair. First each class
   is paired with one leader. Groups that still hold several components get a pivot, the
   root of their largest one, and the distances of all members to it: Jaccard distance is
   a metric, so |d(p,x) - d(p,y)| > 0.2 settles a pair. What is left after some rounds is
   counted pair by pair. A group of near copies so costs its size, not its square, and no
   link that could join two components is left out.
4. Components are propagated as a table.
5. Links lie within components. The number of links counts every pair of classes of a
   component, in blocks of bounded size that meet two by two; no pair becomes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import (bucket_count, bucket_of, bucket_runs, lean, pack, release_shuffles, run_starts, shared_table,
                                 shingle_sets, table, text_chunks, unpack)

WORDS = 5
PERCENT = 80
FLUSH_SHINGLES = 3_000_000
FRAGMENT_BYTES = 4 << 20   # of the input, a fragment
PAIR_FRAGMENTS = 8         # fragments that candidate pairs are counted in
PAIRS_PER_TASK = 20_000
BLOCK_SETS = 256           # classes of one component in a block, about
BLOCK_SHINGLES = 1 << 17   # and their shingles
STAR_ROUNDS = 2            # rounds of pivots before the rest is counted pair by pair

_MESSAGE = "bucket long, kind int, sender long, blob binary"
_MEMBERS = "kind int, doc_id long, n long, k1 long, k2 long, digest long, shingle long, place long, weight long"


def _needed(n):
    """Least overlap with any set: ceil(0.8 n)."""
    return -(-n * PERCENT // 100)


def _message(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
        names=["bucket", "kind", "sender", "blob"])


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit name of a set."""
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _send_segments(fragments: int):
    """kind 0: segments to fragments (a set that repeats within the task is sent once);
    kind 2: the rows' ids, sizes, set keys and text digests, to the sender's own bucket (below zero)."""
    def flush(sender, rows, sets) -> pa.RecordBatch:
        size = [len(s) for s in sets]
        shingle = np.concatenate(sets)
        number = np.repeat(np.arange(len(sets), dtype=np.uint32), size)
        sets.clear()
        order = np.argsort(shingle, kind="stable")
        shingle, number = shingle[order], number[order]
        del order
        out = [(f, 0, sender, pack(np.diff(shingle[s], prepend=np.uint64(0)), number[s])) for f, s in bucket_runs(shingle, fragments)]
        cols = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
        out.append((-1 - sender, 2, sender, pack(*cols)))
        return _message(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, flushed = TaskContext.get().partitionId(), 0
        rows, sets, known, held = [], [], {}, 0
        for batch in batches:
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            digest = batch.column("digest").to_numpy()
            for chunk in text_chunks(batch.column("text")):
                for row, shingles in shingle_sets(chunk, WORDS):
                    key = _set_key(shingles)
                    if len(shingles) and key not in known:
                        known[key] = len(sets)
                        sets.append(shingles)
                        held += len(shingles)
                    at = chunk.first + row
                    rows.append((ids[at], null[at], len(shingles), *key, known.get(key, -1), digest[at]))
                if held >= FLUSH_SHINGLES:
                    yield flush((task << 20) + flushed, rows, sets)
                    rows, sets, known, held, flushed = [], [], {}, 0, flushed + 1
        if rows:
            yield flush((task << 20) + flushed, rows, sets or [np.zeros(0, np.uint64)])

    return run


def _answer_segments(blobs: pa.Table) -> pa.Table:
    """A fragment's shingles that occur twice or more, back to each sender with their
    document frequency; other kinds pass through."""
    if blobs.column("kind")[0].as_py() != 0:
        return blobs
    senders = blobs.column("sender").to_numpy()
    parts = [unpack(b.as_py()) for b in blobs.column("blob")]
    shingle = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    number = np.concatenate([p[1] for p in parts])
    part = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(shingle, kind="stable")
    starts = run_starts(shingle[order])
    size = np.diff(np.append(starts, len(order)))
    frequency = np.empty(len(order), np.uint32)
    frequency[order] = np.repeat(size, size)
    out, at = [], 0
    for k, p in enumerate(parts):
        own = slice(at, at := at + len(p[0]))
        hit = np.flatnonzero(frequency[own] > 1)
        if len(hit):
            out.append((-1 - int(senders[k]), 1, int(senders[k]), pack(
                np.diff(shingle[own][hit], prepend=np.uint64(0)), number[own][hit], frequency[own][hit])))
    return pa.Table.from_batches([_message(out)])


def _prefixes(blobs: pa.Table) -> pa.Table:
    """Per sender: its rows (kind 0) and the prefix shingles of sets that can link (kind 1)."""
    shingle, number, frequency = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    for kind, blob in zip(blobs.column("kind").to_pylist(), blobs.column("blob"), strict=True):
        p = unpack(blob.as_py())
        if kind == 2:
            rows = p
        else:
            shingle.append(np.cumsum(p[0], dtype=np.uint64))
            number.append(p[1])
            frequency.append(p[2])
    ids, null, n, k1, k2, set_of, digest = rows
    shingle, number, frequency = (np.concatenate(x) for x in (shingle, number, frequency))
    sets = int(set_of.max()) + 1 if len(set_of) else 0
    size, key = np.zeros(sets, np.int64), np.zeros(sets, np.int64)
    has = set_of >= 0
    size[set_of[has]], key[set_of[has]] = n[has], k1[has]
    shared = np.bincount(number, minlength=sets)[:sets]
    alive = 100 * shared >= PERCENT * size
    order = np.lexsort((shingle, frequency, number))
    order = order[alive[number[order]]]
    shingle, number = shingle[order], number[order]
    # shingles of no other document come first in the order and match nothing
    place = np.arange(len(number)) - np.searchsorted(number, number) + (size - shared)[number]
    keep = place < (size - _needed(size) + 1)[number]
    # how common a set's shingles are on average: the text that copies were made of leads
    weight = (np.bincount(number, frequency[order].astype(np.float64), minlength=sets)[:sets] * 1000 / np.maximum(size, 1)).astype(np.int64)
    a, b = len(ids), int(keep.sum())
    kind = np.repeat(np.array([0, 1], np.int32), (a, b))
    pad = np.zeros(b, np.int64)
    return pa.table({
        "kind": kind,
        "doc_id": pa.array(np.concatenate((ids, pad)), pa.int64(), mask=np.concatenate((null.astype(bool), pad == 0))),
        "n": np.concatenate((n, size[number[keep]])), "k1": np.concatenate((k1, key[number[keep]])),
        "k2": np.concatenate((k2, pad)), "digest": np.concatenate((digest, pad)), "shingle": np.concatenate((np.zeros(a, np.int64), shingle[keep].view(np.int64))),
        "place": np.concatenate((np.zeros(a, np.int64), place[keep])), "weight": np.concatenate((np.zeros(a, np.int64), weight[number[keep]]))})


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, blobs = [], []
        for chunk in text_chunks(batch.column("text")):
            for _, shingles in shingle_sets(chunk, WORDS):
                keys.append(_set_key(shingles)[0])
                blobs.append(pack(shingles))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["k1", "shingles"])


def _cut_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each class, for the pair tasks (h, fragment)."""
    for batch in batches:
        out = [[], [], [], []]
        for h, k1, blob in zip(*(batch.column(c).to_pylist() for c in ("h", "k1", "shingles")), strict=True):
            (shingles,) = unpack(blob)
            fragment = bucket_of(shingles, PAIR_FRAGMENTS)
            edges = np.searchsorted(fragment, np.arange(PAIR_FRAGMENTS + 1))
            for f in range(PAIR_FRAGMENTS):
                for column, value in zip(out, (h, f, k1, shingles[edges[f]:edges[f + 1]].tobytes()), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.binary())], names=["h", "f", "k1", "segment"])


def _partial_overlaps(pairs: pa.Table, segments: pa.Table) -> pa.Table:
    """One fragment of a task's pairs: a packed row of partial overlaps."""
    sets = dict(zip(segments.column("k1").to_pylist(), (np.frombuffer(b.as_py(), np.uint64) for b in segments.column("segment")),
                    strict=True))
    x, y = (np.array(pairs.column(c)[0].as_py(), np.int64) for c in ("xs", "ys"))
    part = np.zeros(len(x), np.uint32)
    for i, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        a, b = sets[a], sets[b]
        if len(a) > len(b):
            a, b = b, a
        if len(b):
            part[i] = (b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()
    return pa.table({"h": pairs.column("h"), "blob": pa.array([pack(x, y, part)], pa.binary())})


def _sum_overlaps(fragments: pa.Table) -> pa.Table:
    """The overlap of each pair of a task: the sum over its fragments."""
    total = None
    for blob in fragments.column("blob"):
        x, y, part = unpack(blob.as_py())
        total = part.astype(np.int64) if total is None else total + part
    return pa.table({"x": x, "y": y, "overlap": total})


def _count_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, y, nx, ny, overlap): partial overlaps per fragment, summed per pair. Pairs are
    dealt to tasks by x and a part of y, so one x with very many partners spreads over all
    tasks; a task's pairs (about PAIRS_PER_TASK) travel as one packed row a fragment."""
    spark = pairs.sparkSession
    tasks = max(1, -(-pairs.count() // PAIRS_PER_TASK))
    salt = F.pmod(F.xxhash64("y"), F.lit(max(16, tasks)))
    dealt = pairs.withColumn("h", F.pmod(F.xxhash64("x", salt), F.lit(tasks)).cast("long"))
    need = dealt.select("h", F.explode(F.array("x", "y")).alias("k1")).distinct()
    segments = need.join(sets, "k1").select("h", "k1", "shingles").mapInArrow(lean(_cut_sets), "h long, f int, k1 long, segment binary")
    packed = dealt.groupBy("h").agg(F.collect_list(F.struct("x", "y")).alias("p")).select(
        "h", F.col("p.x").alias("xs"), F.col("p.y").alias("ys"),
        F.explode(F.sequence(F.lit(0), F.lit(PAIR_FRAGMENTS - 1))).alias("f"))
    parts = packed.groupBy("h", "f").cogroup(segments.groupBy("h", "f")).applyInArrow(lean(_partial_overlaps), "h long, blob binary")
    total = parts.groupBy("h").applyInArrow(lean(_sum_overlaps), "x long, y long, overlap long")
    return shared_table(pairs.join(total, ["x", "y"]), "pair-overlaps", spark)


def _linked() -> F.Column:
    return 100 * F.col("overlap") >= PERCENT * (F.col("nx") + F.col("ny") - F.col("overlap"))


def _reachable(n, place, other_n) -> F.Column:
    """Whether a set of ``n`` shingles, ``place`` of them before the first common one, can
    link with a set of ``other_n`` (the positional filter, one side of it)."""
    return (100 + PERCENT) * (n - place) >= PERCENT * (n + other_n)


def _live(entries: DataFrame) -> DataFrame:
    """Drops members that cannot link even with the least set of their group, and groups
    of one, twice (the second pass sees the groups that the first one left)."""
    group = Window.partitionBy("shingle")
    for _ in range(2):
        least = F.greatest(F.min("n").over(group), F.ceil(F.col("n") * PERCENT / 100))
        entries = entries.withColumn("least", least).where(_reachable(F.col("n"), F.col("place"), F.col("least")))
        entries = entries.withColumn("c", F.count(F.lit(1)).over(group)).where("c > 1").drop("least", "c")
    return entries


def _components(links: DataFrame) -> DataFrame:
    """(node, label): the least node reachable, for every node of a link. Labels pass along
    links and then jump to their label's label, until nothing changes."""
    spark = links.sparkSession
    edges = shared_table(links.select("x", "y").union(links.select("y", "x")).toDF("a", "b"), "links", spark)
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = shared_table(labels, "labels", spark)
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("label"))
        step = shared_table(step.join(jump, "via", "left").select(
            "node", "old", F.least("via", F.coalesce("label", "via")).alias("label")), "labels", spark)
        labels = step.select("node", "label")
        if step.where("label <> old").limit(1).count() == 0:
            return labels


def class_components(entries: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node, label) of the classes with a link, None if there is no candidate.
    ``entries`` (shingle, k1, n, place, weight): prefix shingles of candidate groups;
    ``sets`` (k1, shingles). Every candidate pair is counted, in one component already, or settled
    by the triangle inequality."""
    spark = entries.sparkSession
    nodes = entries.groupBy("k1").agg(F.max("n").alias("n"), F.max("weight").alias("weight"))
    sizes = shared_table(nodes, "classes", spark)
    group = Window.partitionBy("shingle")
    checked = labels = None

    def count(pairs: DataFrame) -> bool:
        """Count new pairs (x, y), in either order; update ``checked`` and ``labels``."""
        nonlocal checked, labels
        pairs = pairs.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        if checked is not None:
            pairs = pairs.join(checked.select("x", "y"), ["x", "y"], "left_anti")
        pairs = pairs.join(sizes.select(F.col("k1").alias("x"), F.col("n").alias("nx")), "x").join(
            sizes.select(F.col("k1").alias("y"), F.col("n").alias("ny")), "y")
        pairs = shared_table(pairs.select("x", "y", "nx", "ny"), "pairs", spark)
        if pairs.limit(1).count() == 0:
            return False
        counted = _count_pairs(pairs, sets)
        checked = counted if checked is None else checked.unionByName(counted)
        labels = _components(checked.where(_linked()))
        return True

    def labelled(rows: DataFrame) -> DataFrame:
        """Adds the label (a class without a link is its own) and keeps the groups that
        still hold several components."""
        if labels is None:
            rows = rows.withColumn("label", F.col("k1"))
        else:
            rows = rows.join(labels.select(F.col("node").alias("k1"), "label"), "k1", "left").withColumn(
                "label", F.coalesce("label", "k1"))
        # with two components or more, and in each group only those who can link
        return rows.withColumn("lo", F.min("label").over(group)).withColumn("hi", F.max("label").over(group)).where(
            "lo <> hi").drop("lo", "hi")

    # first one pair a class: with the heaviest class that shares a group with it
    groups = entries.groupBy("shingle").agg(F.max(F.struct("weight", "k1")).alias("leader"))
    first = entries.join(groups, "shingle").where("k1 <> leader.k1").groupBy("k1").agg(
        F.max("leader")["k1"].alias("y"))
    if not count(first.select(F.col("k1").alias("x"), "y")):
        return None
    active = shared_table(labelled(entries), "open-groups", spark)
    for round_ in range(STAR_ROUNDS + 1):
        if active.limit(1).count() == 0:
            break
        if round_ == STAR_ROUNDS:  # the rest, pair by pair
            a, b = active.alias("a"), active.alias("b")
            meet = F.expr(f"a.shingle = b.shingle AND a.k1 < b.k1 AND a.label <> b.label AND abs(a.d - b.d) <= {_REACH}")
            able = _reachable(F.col("a.n"), F.col("a.place"), F.col("b.n")) & _reachable(F.col("b.n"), F.col("b.place"), F.col("a.n"))
            count(a.join(b, meet).where(able).select(F.col("a.k1").alias("x"), F.col("b.k1").alias("y")))
            break
        # the pivot of a group: the heaviest class of the component that most members are in
        centres = active.groupBy("label").agg(F.max(F.struct("weight", "k1"))["k1"].alias("pivot"))
        pivots = active.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("shingle").agg(
            F.max(F.struct("c", "label"))["label"].alias("label")).join(centres, "label").drop("label")
        around = shared_table(active.drop("label", "d").join(pivots, "shingle"), "around", spark)
        count(around.select(F.col("k1").alias("x"), F.col("pivot").alias("y")))
        both = F.explode(F.array(F.struct(F.col("x").alias("pivot"), F.col("y").alias("k1")),
                                 F.struct(F.col("y").alias("pivot"), F.col("x").alias("k1"))))
        distance = checked.select(both.alias("p"), F.floor(
            (1 - F.col("overlap") / (F.col("nx") + F.col("ny") - F.col("overlap"))) * _SCALE).alias("d")).select("p.pivot", "p.k1", "d")
        rest = labelled(around).join(distance, ["pivot", "k1"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
        # whoever has no member of another component in reach is settled
        near = Window.partitionBy("shingle").orderBy("d").rangeBetween(-_REACH, _REACH)
        rest = rest.withColumn("lo", F.min("label").over(near)).withColumn("hi", F.max("label").over(near)).where("lo <> hi")
        active = shared_table(rest.select("shingle", "k1", "n", "place", "weight", "label", "d"), "open-groups", spark)
    return labels


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every set of ``a`` with every set of ``b``. Shingles that many of
    the sets hold are counted by matrix products, the others by their pairs."""
    flat = [np.concatenate(x) for x in (a, b)]
    row = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (a, b)]
    known = np.intersect1d(*flat)
    out = np.zeros((len(a), len(b)), np.int64)
    if not len(known):
        return out
    at, held, often = [], [], []
    for f, r in zip(flat, row, strict=True):
        hit = np.minimum(np.searchsorted(known, f), len(known) - 1)
        inside = known[hit] == f
        order = np.argsort(hit[inside], kind="stable")
        at.append(hit[inside][order])
        held.append(r[inside][order])
        often.append(np.bincount(at[-1], minlength=len(known)))
    dense = np.flatnonzero(16 * often[0] * often[1] > len(a) * len(b))
    for k in range(0, len(dense), 4096):
        some = dense[k:k + 4096]
        grids = []
        for i, x in enumerate((a, b)):
            hit = np.minimum(np.searchsorted(some, at[i]), len(some) - 1)
            inside = some[hit] == at[i]
            grids.append(np.zeros((len(x), len(some)), np.float32))
            grids[i][held[i][inside], hit[inside]] = 1
        out += (grids[0] @ grids[1].T).astype(np.int64)
    rare = np.ones(len(known), bool)
    rare[dense] = False
    entry = np.flatnonzero(rare[at[0]])
    first = np.concatenate(([0], np.cumsum(often[1])))
    partners = often[1][at[0][entry]]
    steps = np.cumsum(partners) >> 21  # about two million pairs at a time
    for step in np.unique(steps):
        mine = steps == step
        e, n = entry[mine], partners[mine]
        other = np.repeat(first[at[0][e]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        out += np.bincount(np.repeat(held[0][e], n) * len(b) + held[1][other], minlength=out.size).reshape(out.shape)
    return out


def _count_links(met: pa.Table) -> pa.Table:
    """Per class and meeting of two blocks (i, j) of a component: the rows linked with it."""
    label, i, j, block, k1, rows = (met.column(c).to_numpy() for c in ("label", "i", "j", "block", "k1", "rows"))
    blobs = met.column("shingles")
    order = np.lexsort((block, j, i, label))
    new = np.ones(len(order), bool)
    new[1:] = np.any([np.diff(x[order]) != 0 for x in (label, i, j)], axis=0)
    keys, links = [], []
    for own in np.split(order, np.flatnonzero(new)[1:]):
        sets = [unpack(blobs[int(r)].as_py())[0] for r in own]
        size = np.array([len(x) for x in sets])
        low = int((block[own] == i[own[0]]).sum())
        alone = i[own[0]] == j[own[0]]
        a, b = slice(0, low), slice(0, low) if alone else slice(low, None)
        if not len(size[a]) or not len(size[b]):
            continue
        both = _overlaps(sets[a], sets[b])
        linked = 100 * both >= PERCENT * (size[a][:, None] + size[b][None, :] - both)
        if alone:
            np.fill_diagonal(linked, False)
        keys.append(k1[own[a]])
        links.append(linked @ rows[own[b]])
        if not alone:
            keys.append(k1[own[b]])
            links.append(rows[own[a]] @ linked)
    keys, links = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, links))
    return pa.table({"k1": pa.array(keys, pa.int64()), "links": pa.array(links, pa.int64())})


def class_links(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(k1, links): the rows of other classes that each class is linked with. ``classes``
    (k1, label, n, rows): the members of components; ``sets`` (k1, shingles). Members of a
    component are dealt to blocks, and every two blocks meet once."""
    spark = classes.sparkSession
    sums = classes.groupBy("label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("size"), F.sum("rows").alias("all_rows"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("long")
    sums = shared_table(sums.withColumn("blocks", blocks), "component-sizes", spark)
    found = classes.join(sums, "label")
    two = found.where("c = 2").select("k1", (F.col("all_rows") - F.col("rows")).alias("links"))
    total = sums.where("c > 2").agg(F.sum(F.col("size") * F.col("blocks"))).first()[0] or 0
    tasks = int(max(64, -(-total // BLOCK_SHINGLES)))
    dealt = found.where("c > 2").withColumn("block", F.pmod(F.xxhash64("k1"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "k1", "rows")
    dealt = dealt.withColumn("h", F.pmod(F.xxhash64("label", "i", "j"), F.lit(tasks))).join(sets, "k1")
    counted = dealt.groupBy("h").applyInArrow(lean(_count_links), "k1 long, links long")
    return shared_table(two.unionByName(counted).groupBy("k1").agg(F.sum("links").alias("links")), "class-links", spark)


_SCALE = 10 ** 9                                          # distances as integers
_REACH = (100 - PERCENT) * _SCALE // 100 + 2              # two for what floor cuts off


def near_duplicates(docs: DataFrame, links: bool = True) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, class_id (a name of its set), component (a
    name of its component, which rows without id have too; null without shingles) and
    digest (xxhash64 of the text, which tells rows of one id apart). With ``links`` also
    n_links: how many other rows the row is linked with.

    A null text, or one without words, has no shingles and links with nothing (its
    component is its own id). Rows with equal sets are linked whatever their ids; repeated
    rows are rows of one class. component_id is the least non-null doc_id of the component
    (null if it has none). An empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    fragments = bucket_count(docs.select("text"), FRAGMENT_BYTES, 32)
    sent = rows.mapInArrow(lean(_send_segments(fragments)), _MESSAGE)
    answered = sent.groupBy("bucket").applyInArrow(lean(_answer_segments), _MESSAGE)
    found = shared_table(answered.groupBy("bucket").applyInArrow(lean(_prefixes), _MEMBERS), "members", spark)
    del sent, answered
    release_shuffles(spark)
    members = found.where("kind = 0").select("doc_id", "n", "k1", "k2", "digest")

    # equal sets of several senders have equal rows
    entries = shared_table(_live(found.where("kind = 1").select("shingle", "k1", "n", "place", "weight").distinct()), "groups", spark)
    candidates = entries.select("k1").distinct()
    names = members.where("n > 0").groupBy("k1").agg(F.min("doc_id").alias("doc_id")).join(candidates, "k1", "left_semi")
    # an id that repeats with other texts brings their sets too; they are dropped by name
    wanted = names.select(F.col("doc_id").alias("wanted")).distinct()
    texts = rows.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = texts.mapInArrow(lean(_class_sets), "k1 long, shingles binary").join(candidates, "k1", "left_semi").dropDuplicates(["k1"])
    sets = shared_table(sets, "sets", spark)
    release_shuffles(spark)
    labels = class_components(entries, sets)

    classes = members.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"),
                                                F.count(F.lit(1)).alias("rows"))
    if labels is not None:
        classes = classes.join(labels.select(F.col("node").alias("k1"), "label"), "k1", "left")
    else:
        classes = classes.withColumn("label", F.lit(None).cast("long"))
    classes = classes.withColumn("label", F.coalesce("label", "k1"))
    if links:
        linked = None
        if labels is not None:
            linked = class_links(classes.join(labels.select(F.col("node").alias("k1")), "k1", "left_semi").where(
                "n > 0").select("k1", "label", "n", "rows"), sets)
        classes = classes.withColumn("links", F.lit(0).cast("long")) if linked is None else classes.join(linked, "k1", "left")
        classes = classes.withColumn("links", F.coalesce("links", F.lit(0)) + F.col("rows") - 1)
    component = classes.where("n > 0").groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.where("n > 0").join(component, "label").select(
        "k1", "k2", "label", "component_id", *["links"] * links)
    out = members.join(classes, ["k1", "k2"], "left")
    return out.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).cast(id_type).alias("component_id"),
                      F.col("k1").alias("class_id"), F.col("label").alias("component"), "digest",
                      *[F.coalesce("links", F.lit(0)).alias("n_links")] * links)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh FROM x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id, n.n
"""


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), links=False).select("doc_id", "n_shingles", "component_id")


LINKS_SQL = SQL[:SQL.index("SELECT d.doc_id")] + r"""SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
    least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id, coalesce(k.n_links, 0) AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.x = d.doc_id
LEFT JOIN (SELECT x, count(*) AS n_links FROM e GROUP BY x) k ON k.x = d.doc_id GROUP BY d.doc_id, n.n, k.n_links
"""


def op8_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")
