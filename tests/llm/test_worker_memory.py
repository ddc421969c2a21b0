"""What the operators' tasks leave in the reused Python workers."""
import gc
import inspect
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa

from tabsmith.llm import bpe, common, jaccard, langid, suffix_dedup


def codec():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.Codec(ranks, public_tokenizers.PATTERN, *bpe.serialise_model(ranks))


def test_codec_and_its_cache_go_with_the_task():
    one = codec()
    assert one.decode(one.encode("some words, some words")) == b"some words, some words"
    gone = weakref.ref(one)
    gc.disable()
    try:
        del one
        assert gone() is None  # not only when the cyclic collector comes by
    finally:
        gc.enable()


def test_sets_are_let_go_once_they_are_packed():
    sets = [np.arange(9, dtype=np.uint64)]
    flush = inspect.getclosurevars(jaccard._send_segments(4)).nonlocals["flush"]
    batch = flush(0, [(1, False, 9, 5, 6, 0, 7)], sets)
    assert batch.num_rows and not sets


def test_lean_keeps_results_and_arguments(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))

    def batches(rows):
        yield from rows

    assert list(common.lean(batches)([1, 2])) == [1, 2] and len(calls) == 2
    for work in (jaccard._answer_segments, jaccard._partial_overlaps, suffix_dedup._send_segments(4)):
        assert inspect.getfullargspec(common.lean(work)).args == inspect.getfullargspec(work).args
    assert common.lean(lambda table: table.num_rows)(pa.table({"a": [1]})) == 1 and len(calls) == 3


def test_predictions_leave_a_task_chunk_by_chunk(spark, monkeypatch):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 40, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = langid.train(docs)
    seen = langid.predict(docs, model)
    whole = {r.row.doc_id: (r.lang_pred, r.score) for r in seen.collect()}
    assert whole == {r.row.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.repartition(7), model).collect()}
    assert len(whole) == 40 and all(whole[i][0] == ("en" if i % 2 else "de") for i in whole)
