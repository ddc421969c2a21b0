import pytest


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text[, lang[, source]]) rows, with extra columns whose
    names clash with internal ones."""
    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a") for r in rows]
        frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string").selectExpr(
            "*", "cast(char_length(text) as long) AS n_chars")
        if extra:
            frame = frame.selectExpr("*", "1 AS size", "'x' AS row", "2 AS grp", "3 AS digest", "4 AS label", "5 AS bucket",
                                     "6 AS n", "7 AS x", "'y' AS order_key", "8 AS score", "9 AS nth")
        return frame
    return make


@pytest.fixture
def prose():
    """A seeded generator of word texts."""
    import random

    def make(seed, n_words, vocabulary=400):
        rnd = random.Random(seed)
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(vocabulary)]
        return " ".join(rnd.choice(words) for _ in range(n_words))
    return make
