"""op13 against brute force, and the guarantee of the summaries."""
import random
import re
from collections import Counter

import numpy as np

from tabsmith.llm import phrases
from tabsmith.llm.common import pack


def expected(rows, min_count, keep=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    best = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= min_count:
            best[lang, p] = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
    covered = {(lang, p[i:i + k]) for (lang, p) in best for k in range(2, len(p)) for i in range(len(p) - k + 1)
               if 100 * f[lang, p] >= 80 * f[lang, p[i:i + k]]}
    out = []
    for lang in n:
        kept = sorted(((-s, -f[lang, p], " ".join(p).encode(), left, right) for (g, p), (s, _, left, right) in best.items()
                       if g == lang and (lang, p) not in covered))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(kept[:keep], 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n_docs):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n_docs):
        lang = rnd.choice(["en", "de", "und", None])
        words = [rnd.choice(("in", "the", "New", "york", "city", "of", "straße", "a", "b", "c")) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 4)):
            words[len(words) // 2:len(words) // 2] = [rnd.choice(("san juan capistrano", "well known fixed phrase", "of the"))]
        rows.append((lang, "".join(w + rnd.choice((" ", "  ", "\t", " ", ", ", "\n")) for w in words)))
    return rows


def test_equals_brute_force(docs):
    rows = corpus(1, 150)
    want = expected(rows, 8)
    assert len(want) > 40 and {len(w[2].split()) for w in want} == {2, 3, 4}
    assert got(phrases.collocations(docs([(i, t, g) for i, (g, t) in enumerate(rows)]), min_count=8)) == want


def test_small_units_partitions_and_merges_change_nothing(docs, monkeypatch):
    rows = corpus(2, 120)
    monkeypatch.setattr(phrases, "UNIT_BYTES", 400)
    monkeypatch.setattr(phrases, "HELD_BYTES", 900)
    monkeypatch.setattr(phrases, "MERGE_ENTRIES", 50)
    monkeypatch.setattr(phrases, "HASH_BYTES", 30)
    monkeypatch.setattr(phrases, "partition_count", lambda docs: 3)
    assert got(phrases.collocations(docs([(i, t, g) for i, (g, t) in enumerate(rows)]), min_count=8, keep=5)) == expected(rows, 8, 5)


def test_summary_keeps_every_frequent_key():
    rnd = np.random.default_rng(4)
    for share in (0.0, 0.33):
        keys = rnd.integers(0, 3000, 60_000).astype(np.uint64)
        keys[:int(share * len(keys))] = 7                    # a third of the mass is one key
        rnd.shuffle(keys)
        blobs = []
        for part in np.array_split(keys, 25):
            k, c = np.unique(part, return_counts=True)
            blobs.append(pack(np.diff(k, prepend=np.uint64(0)), c.astype(np.uint32)))
        old, phrases.MERGE_ENTRIES = phrases.MERGE_ENTRIES, 700
        try:
            kept = phrases.survivors(blobs, len(keys), 30)
        finally:
            phrases.MERGE_ENTRIES = old
        k, c = np.unique(keys, return_counts=True)
        assert np.isin(k[c >= 30], kept).all()
        assert len(kept) <= len(keys) // 30 + 1


def test_merges_of_summaries_stay_within_the_bound():
    rnd = np.random.default_rng(6)
    parts = [rnd.zipf(1.3, 4000).astype(np.uint64) for _ in range(8)]
    summaries = []
    for p in parts:
        s = phrases.Summary(200)
        s.merge(*[x.astype(t) for x, t in zip(np.unique(p, return_counts=True), (np.uint64, np.int64), strict=True)])
        summaries.append(s)
    total = summaries[0]
    lost = sum(s.lost for s in summaries[1:])
    for s in summaries[1:]:
        total.merge(s.keys, s.counts)
    every = np.concatenate(parts)
    assert total.lost + lost <= len(every) / 201
    for key, count in zip(total.keys, total.counts, strict=True):
        assert 0 <= (every == key).sum() - count <= total.lost + lost


def test_scores_past_64_bits_are_exact(spark):
    big = 5 * 10 ** 13
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(big, 2 * big + 1, big + 3)], "a long, l long, r long")
    score = F.expr("(CAST(a AS decimal(20,0)) * CAST(2000000 AS decimal(10,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    assert df.select(score.cast("long")).first()[0] == 2_000_000 * big // (3 * big + 4)


def test_odd_rows_and_empty_table(docs):
    rows = [(None, None), ("en", ""), ("en", "Ünï cöde \U0001f600 " * 40), (None, "same row " * 8), (None, "same row " * 8),
            ("", "a b. a b " * 30), ("en", " \t\n"), ("de", "x" * 50_000 + " y z" * 9000)]
    assert got(phrases.collocations(docs([(i, t, g) for i, (g, t) in enumerate(rows)]))) == expected(rows, 30)
    assert got(phrases.collocations(docs([]))) == []
