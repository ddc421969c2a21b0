import hashlib
import random

import numpy as np
import pytest

from tabsmith.llm import jaccard, suffix_dedup
from tabsmith.llm.suffix_dedup import anchors, columnwise_cover


def cut_by_rule(rows):
    """doc_id -> (bytes, removed, runs, digest) by looking at every window."""
    least = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p:p + 50]
            least[w] = min(doc, least.get(w, doc))
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if least[raw[p:p + 50]] < doc:
                gone[p:p + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[doc] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture
def passages(prose):
    rnd = random.Random(5)
    shared = [prose(s, 40) for s in range(4)]
    rows = [(i, prose(100 + i, rnd.randint(1, 120))) for i in range(40)]
    for i in range(40, 90):  # passages at unaligned places, cut at their edges, copies, repeats within a text
        piece = rnd.choice(shared)
        a = rnd.randint(0, 60)
        rows.append((i, prose(200 + i, rnd.randint(0, 30)) + piece[a:a + rnd.randint(40, 160)] + prose(300 + i, rnd.randint(0, 30))))
    rows += [(90, rows[3][1]), (91, "é" * 300), (92, "x" + "é" * 200), (93, "ab" * 200), (94, "ab" * 150 + "c"), (95, None), (96, ""),
             (97, shared[0][:49]), (98, shared[0][:50]), (99, shared[1] + "\0" * 80), (100, "\0" * 90)]
    return rows


def test_suffix_dedup_against_every_window(docs, passages):
    rows = list(passages)
    random.Random(1).shuffle(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.remove_repeats(docs(rows).repartition(5)).collect()}
    assert got == cut_by_rule(rows)


def test_suffix_dedup_many_flushes(docs, passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FLUSH_ANCHORS", 50)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_ROWS", 7)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.remove_repeats(docs(passages).repartition(3)).collect()}
    assert got == cut_by_rule(passages)


def test_suffix_dedup_keeps_rows_and_text(docs):
    text = "This very passage stands in two documents and is over fifty bytes long."
    rows = suffix_dedup.remove_repeats(docs([(1, text), (2, "Mine: " + text + " End")]), keep_rows=True).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].kept_text == text
    assert by[2].kept_text == "Mine: " + " End"
    assert by[2].row.grp == 2 and by[2].row.source == "a"


def test_every_shared_window_has_an_anchor():
    rnd = np.random.default_rng(3)
    passage = rnd.integers(97, 103, 64).astype(np.uint8)
    for _ in range(50):
        texts = [np.concatenate((rnd.integers(97, 103, rnd.integers(0, 90)), passage, rnd.integers(97, 103, 40))).astype(np.uint8) for _ in range(2)]
        found = [dict(zip(*anchors(t, np.array([0, len(t)])), strict=True)) for t in texts]
        starts = [len(t) - 104 for t in texts]
        for p in range(15):
            at = [{k - s - p: h for k, h in f.items() if s + p <= k <= s + p + 25} for f, s in zip(found, starts, strict=True)]
            assert set(at[0].items()) & set(at[1].items())


def test_columnwise_cover_against_pairs():
    rnd = np.random.default_rng(7)
    m, width, length = 120, 15, 10
    x = rnd.integers(0, 2, (m, width)).astype(np.uint8)
    doc = rnd.integers(0, 30, m)
    low, high = columnwise_cover(np.ascontiguousarray(x.T), doc, np.zeros(m, int), np.full(m, width - length), length)
    for i in range(m):
        hits = [c for c in range(width - length + 1)
                if any(doc[j] < doc[i] and (x[j, c:c + length] == x[i, c:c + length]).all() for j in range(m))]
        assert (low[i], high[i]) == ((min(hits), max(hits)) if hits else (-1, -1))


# ------------------------------------------------------------------ n-gram Jaccard

def components_by_rule(rows):
    def shingles(text):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        import re
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


@pytest.fixture
def near_copies(prose):
    rnd = random.Random(11)
    rows = []
    for base in range(8):
        words = prose(base, 150).split()
        for _ in range(12):  # edits around the threshold, chains of edits of edits
            copy = list(words)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = f"new{rnd.randrange(10**6)}"
            rows.append(" ".join(copy))
            if rnd.random() < 0.3:
                words = copy
    common = prose(77, 60)
    rows += [common + " " + prose(500 + i, rnd.randint(3, 14)) for i in range(25)]  # mostly one passage
    rows += [prose(900 + i, 30, 6) for i in range(10)] + ["one two", "One Two", "one", "", None, "a b a x b", "b a x a b"]
    rows += [rows[0], rows[0].upper(), prose(3, 5)]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def test_jaccard_components_against_all_pairs(docs, near_copies):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(near_copies).repartition(4)).collect()}
    assert got == components_by_rule(near_copies)


def links_by_rule(rows):
    def shingles(text):
        w = [x.lower() for x in (text or "").split()]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    return sorted((d, sum(i != j and bool(a & b) and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)))
                  for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_counts_every_link(docs, near_copies, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    base = [d for d, t in near_copies if t][:1]
    rows = near_copies + [(1000 + i, dict(near_copies)[base[0]]) for i in range(3)]
    got = sorted((r.doc_id, r.n_links) for r in jaccard.near_duplicates(docs(rows).repartition(3)).collect())
    assert got == links_by_rule(rows)


def test_overlaps_of_rare_and_common_shingles():
    rnd = np.random.default_rng(2)
    sets = [np.unique(np.concatenate((np.arange(40), rnd.integers(40, 400, 30)))).astype(np.uint64) for _ in range(50)]
    want = [[len(np.intersect1d(x, y)) for y in sets[20:]] for x in sets[:20]]
    assert (jaccard._overlaps(sets[:20], sets[20:]) == want).all()


@pytest.mark.parametrize("rounds", [1, 2])
def test_jaccard_with_small_tasks_and_few_star_rounds(docs, near_copies, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "FLUSH_SHINGLES", 300)
    monkeypatch.setattr(jaccard, "PAIRS_PER_TASK", 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(near_copies).repartition(3)).collect()}
    assert got == components_by_rule(near_copies)
