"""op12 against brute force."""
import hashlib
import random
import re

import numpy as np

from tabsmith.llm import decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, items):
    out = []
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    for doc_id, text in rows:
        w = words(text)
        hit, ids = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i:i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    ids |= found
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS row", "2 AS code", "'x' AS words", "3 AS n")
    return sorted((tuple(r) for r in decontaminate.decontaminate(docs(rows), bench).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def test_equals_brute_force(spark, docs):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcé9") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice((3, 9, 10, 11, 14, 40)))) for i in range(30)]
    items += [(100, items[0][1]), (101, "A"), (102, "one TWO"), (9, "unused"), (103, items[5][1] + " " + items[6][1]), (104, "zz " * 14)]
    rows = []
    for i in range(120):
        parts = [text(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(items)[1].split(" ")
            a = rnd.randint(0, 2)
            parts += [" ,".join(part[a:a + rnd.randint(8, 40)]).upper().replace("É", "é"), text(rnd.randint(0, 5))]
        rows.append((i, " - ".join(parts)))
    rows += [(500, "zz " * 40), (501, "One/two"), (502, "b a c")]
    want = expected(rows, items)
    assert 10 < sum(w[-1] for w in want) < len(want)
    assert run(spark, docs, rows, items) == want


def test_odd_rows(spark, docs):
    passage = "this passage of a benchmark has ten words or more in it"
    rows = [(1, None), (2, ""), (None, passage), (None, passage), (3, "\x00 \t\n"), (4, "émigré ñandú 中文 \U0001f600"),
            (5, "word after word " * 20_000 + passage.upper()), (5, passage[:-3])]
    items = [(None, passage), (7, None), (8, ""), (9, "..."), (10, "中文"), (10, passage + " and on"), (11, "no such words here at all, none of them anywhere in any document")]
    assert run(spark, docs, rows, items) == expected(rows, items)


def test_passage_in_a_third_of_all_documents(spark, docs, prose):
    passage = "every third document of this table holds the very same passage here"
    rows = [(i, prose(i, 20) + (" " + passage if i % 3 == 0 else "")) for i in range(1500)]
    found = run(spark, docs, rows, [(1, passage), (2, passage + " twice")])
    assert sum(r[-1] for r in found) == 500
    assert {r[2:4] for r in found if r[-1]} == {(12, 2)}


def test_empty_tables(spark, docs):
    assert run(spark, docs, [], [(1, "some text")]) == []
    assert [r[1:4] for r in run(spark, docs, [(1, "some text")], [])] == [(2, 0, 0)]


def test_filter_passes_every_code_that_it_was_made_of(spark):
    codes = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    bits = decontaminate.bit_filter(spark.createDataFrame([(int(c),) for c in codes], "code long"))
    assert decontaminate._passes(bits, codes.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(0, 1 << 64, 20000, dtype=np.uint64)
    assert decontaminate._passes(bits, other).mean() < 0.001
