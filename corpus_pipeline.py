"""A training-corpus pipeline over ``documents``: five operators of ``tabsmith.llm`` in a row.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
all but the last return the columns of ``documents``. ``run`` writes every stage's result
to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm import bpe, jaccard, langid, mixing, suffix_dedup
from tabsmith.llm.common import shared_table, table

MIN_LANGUAGE_SCORE = 0.02  # the winner's lead, as a share of its own hits


def _like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in order and type; n_chars follows the text if there is one."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in docs.schema.fields])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: no letters at all, or no language
    clearly ahead. Trained on the labelled rows of its own input."""
    judged = langid.predict(docs, langid.train(docs))
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of links stays: the one with the least id, then the least
    text hash; a row without id only where no row of its component has one. Rows that are
    not linked all stay, also where they share an id or have none; a text without words
    is linked with nothing."""
    found = jaccard.near_duplicates(docs, links=False).where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest"))
    stay = found.groupBy("component").agg(least.alias("r")).select(F.col("r.doc_id").alias("stays"), F.col("r.digest").alias("stays_digest"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("digest"))
    wordless = ~F.coalesce(F.col("row.text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    same = F.col("row.doc_id").eqNullSafe(F.col("stays")) & (F.col("digest") == F.col("stays_digest"))
    kept = rows.where(~wordless).join(stay, same, "left_semi")
    nth = F.row_number().over(Window.partitionBy("row.doc_id", "digest").orderBy(F.xxhash64("row")))
    kept = kept.withColumn("nth", nth).where("nth = 1")
    return kept.select("row.*").unionByName(rows.where(wordless).select("row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document holds are cut out; a document
    of which nothing is left goes."""
    cut = suffix_dedup.remove_repeats(docs, keep_rows=True)
    cut = cut.where("n_removed < n_bytes OR n_bytes = 0")
    names = [F.col(f"row.`{c}`").alias(c) if c != "text" else F.col("kept_text").alias("text") for c in docs.columns]
    return _like(cut.select(*names), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: a row per whole pass, and a row with
    the words of a partial pass where a source's run of blocks begins or ends inside it."""
    plan = mixing.mix(docs).where("taken > 0").select(
        "order_key", F.col("passes").alias("p_passes"), "skip", "part", "wrapped", F.col("size").alias("p_size"))
    # rows equal in id and text share a key: they are paired off by number
    nth = F.row_number().over(Window.partitionBy("order_key").orderBy("p_passes", "part", "skip"))
    plan = plan.withColumn("nth", nth)
    rows = docs.select(F.struct("*").alias("row"), mixing.order_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    rows = rows.withColumn("row_nth", F.row_number().over(Window.partitionBy("row_key").orderBy(F.xxhash64("row"))))
    taken = rows.join(plan, (F.col("row_key") == F.col("order_key")) & (F.col("row_nth") == F.col("nth")))
    copies = F.col("p_passes") + (F.col("part") > 0).cast("long")
    taken = taken.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    words = F.regexp_extract_all("row.text", F.lit("([^\\x20\\x09-\\x0D]+)"))
    body = F.array_join(F.slice(words, (F.col("skip") + 1).cast("int"), (F.col("part") - F.col("wrapped")).cast("int")), " ")
    head = F.array_join(F.slice(words, F.lit(1), F.col("wrapped").cast("int")), " ")
    piece = F.when(F.col("part") >= F.col("p_size"), F.col("row.text")).otherwise(F.trim(F.concat_ws(" ", head, body)))
    text = F.when(F.col("copy") <= F.col("p_passes"), F.col("row.text")).otherwise(piece)
    names = [F.col(f"row.`{c}`").alias(c) if c != "text" else text.alias("text") for c in docs.columns]
    return _like(taken.select(*names), docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and of the decoded bytes."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicate_documents", near_duplicate_documents),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None  # language ID and tokenisation are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}", spark)
    return STAGES[-1][1](spark, docs, sf_dir)
