"""op11 against brute force."""
import random
import zlib
from collections import Counter
from itertools import combinations

import pytest

from tabsmith.llm import variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def lowered(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def expected(rows):
    import re

    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def got(frame):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]


def test_equals_brute_force_on_mutated_words(docs):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abÉñxÿ") for _ in range(rnd.randint(7, 13))) for _ in range(40)]

    def mutate(w):
        i = rnd.randrange(len(w))
        return rnd.choice((w[:i] + w[i + 1:], w[:i] + rnd.choice("abéZ") + w[i:], w[:i] + rnd.choice("abé") + w[i + 1:]))

    words = base + [mutate(w) for w in base for _ in range(6)] + [mutate(mutate(w)) for w in base for _ in range(4)]
    rows = [(i, " ".join(rnd.choices(words, k=60)) + "! 12 " + " ".join(rnd.choices(base[:8], k=80))) for i in range(60)]
    want = expected(rows)
    assert sum(w[1] is not None for w in want) > 5 and max(w[4] for w in want) > 3
    assert sorted(got(variants.spelling_variants(docs(rows))), key=str) == sorted(want, key=str)


def test_chains_lead_to_the_last_form(docs):
    # 2 occurrences -> 20 -> 200, ids chosen so that no letter is lost
    def ids(word, count):
        return [i for i in range(10 * count) if zlib.crc32(f"{i}:{word}".encode()) % 31][:count]

    rows = [(i, w) for w, c in (("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200)) for i in ids(w, c)]
    found = {r[0]: r for r in got(variants.spelling_variants(docs(rows)))}
    assert found["abcdefg"][1:3] == ("abcdefgh", "abcdefghi")
    assert found["abcdefghi"][1:] == (None, "abcdefghi", 200, 1, None)


def test_repeated_letters_odd_rows_and_long_runs(docs):
    long = "aé" * 5000
    rows = [(1, None), (2, ""), (None, "aaaaaaaa aaaaaaa aaaaaaaaa"), (None, "aaaaaaaa aaaaaaa aaaaaaaaa"), (4, "ÀÀÀÀÀÀÀ ààààààà"),
            (5, "ÀÀÀÀÀÀÀ ààààààà"), (6, f"{long} {long}b"), (7, f"{long} {long}b"), (8, "1234567 short"), (8, "1234567 short")]
    assert sorted(got(variants.spelling_variants(docs(rows))), key=str) == sorted(expected(rows), key=str)


def test_empty_table(docs):
    assert got(variants.spelling_variants(docs([]))) == []


def test_every_edit_leaves_a_shared_list():
    rnd = random.Random(9)
    for opened in (set(), {a + b for a in "abc" for b in "abc"}, {"ab", "ca", "bb"}):
        for _ in range(3000):
            w = "".join(rnd.choice("abc") for _ in range(rnd.randint(7, 12)))
            i = rnd.randrange(len(w))
            same = w[:i] + rnd.choice("abcd") + w[i + 1:]
            more = w[:i] + rnd.choice("abcd") + w[i:]
            keys = {x: variants.list_keys(x, opened, 7) for x in (w, same, more)}
            assert keys[w][0] & keys[same][0]
            assert keys[w][0] & keys[more][1]


def test_too_short_words_are_refused(docs):
    with pytest.raises(ValueError):
        variants.spelling_variants(docs([(1, "abc")]), min_length=3)
