import corpus_pipeline as cp
from pyspark.sql import functions as F


def test_stages_keep_columns_and_take_effect(spark, docs, prose):
    base = prose(1, 120)
    passage = prose(2, 40)
    rows = [(i, prose(10 + i, 150), "en", f"s{i % 4}") for i in range(40)]
    rows += [(50, base, "en", "s0"), (51, base + " tail", "en", "s1"), (52, base, "en", None), (52, base, "en", None)]
    rows += [(60 + i, prose(70 + i, 50) + " " + passage + " " + prose(90 + i, 50), "en", "s2") for i in range(4)]
    rows += [(98, None, None, None), (99, "12 34 55", "en", "s3"), (None, prose(55, 80), "en", "s1")]
    frame = docs(rows)
    names = {}
    for name, stage in cp.STAGES:
        out = stage(spark, frame, "")
        out = out.persist()
        names[name] = {str(r.doc_id) for r in out.select("doc_id").collect()}
        if name != "byte_bpe":
            assert out.dtypes == frame.dtypes
        if name == "language_id":
            assert not {"98", "99"} & names[name] and {"50", "None", "0"} <= names[name]
        if name == "near_duplicate_documents":
            assert not {"51", "52"} & names[name] and {"50", "None"} <= names[name]
            assert out.where("doc_id = 50").count() == 1
        if name == "repeated_passages":
            left = out.where(F.col("text").contains(passage)).select("doc_id").collect()
            assert [r.doc_id for r in left] == [60]
        if name == "mix_sources":
            assert out.count() > 0
            total = frame.select(F.sum(F.size(F.split("text", " ")))).first()[0]
            words = out.select(F.sum(F.size(F.split("text", " ")))).first()[0]
            assert abs(words - total) < 0.1 * total
        frame = out


def test_near_duplicates_keep_one_row_of_each_component(spark, docs, prose):
    a, b, c, d = (prose(200 + i, 150) for i in range(4))
    clean = [(None, prose(300 + i, 40)) for i in range(20)]                     # unlinked, without id
    rows = clean + [(None, prose(1, 90)), (None, "X " + prose(1, 90)),          # a component without an id
                    (5, a), (None, a + " tail"), (3, b), (7, b + " tail"), (7, c), (7, d), (9, d), (9, d),
                    (11, None), (None, ""), (None, " ")]
    out = [(r.doc_id, r.text) for r in cp.near_duplicate_documents(spark, docs(rows).repartition(3), "").collect()]
    pair = [x for x in out if x in ((None, prose(1, 90)), (None, "X " + prose(1, 90)))]
    assert len(pair) == 1
    want = clean + pair + [(5, a), (3, b), (7, c), (7, d), (11, None), (None, ""), (None, " ")]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_pipeline_on_empty_table(spark, docs):
    frame = docs([])
    for _, stage in cp.STAGES:
        frame = stage(spark, frame, "")
    assert frame.collect() == []
