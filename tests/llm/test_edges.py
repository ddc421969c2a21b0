"""Null, empty, long, repeated and clashing inputs for every operator."""
import pytest

from tabsmith.llm import bpe, compression, jaccard, kneser_ney, langid, mixing, sharding, suffix_dedup

LONG = "word after word " * 20_000
ODD = [(1, None), (2, ""), (None, "no id at all but some words here to count"), (3, "same text twice, long enough to be cut by a rule of fifty"),
       (4, "same text twice, long enough to be cut by a rule of fifty"), (4, "same text twice, long enough to be cut by a rule of fifty"),
       (5, LONG), (6, "\n \t"), (7, "émigré ñandú 中文 \U0001f600"), (8, "a"), (None, None)]


def encode(docs):
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def language_model(docs):
    return kneser_ney.score(docs, kneser_ney.train(docs))


OPERATORS = {"shard": sharding.shard_documents, "bpe": encode, "langid": langid.identify, "suffix": suffix_dedup.remove_repeats,
             "quality": compression.quality_rules, "jaccard": jaccard.near_duplicates, "lm": language_model, "mix": mixing.mix}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_keep_one_result_each(docs, name):
    got = OPERATORS[name](docs([(a, b, None if a == 3 else "en", None if a == 4 else "s") for a, b in ODD])).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(a) for a, _ in ODD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs([])).collect() == []


def test_buckets_stay_bounded_at_a_hundred_terabytes(spark, monkeypatch):
    import numpy as np

    from tabsmith.llm import common

    df = spark.range(1).selectExpr("'x' AS text")
    for size in (1 << 30, 100 << 40):
        monkeypatch.setattr(common, "input_bytes", lambda df, size=size: size)
        n = common.bucket_count(df)
        assert size / n <= 4 << 20
        hashes = np.array([0, 1 << 40, (1 << 64) - 1], np.uint64)
        assert common.bucket_of(hashes, n).tolist() == [h * n >> 64 if h >> 32 == 0 else (h >> 32) * n >> 32 for h in hashes.tolist()]
