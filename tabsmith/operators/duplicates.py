"""Duplicates of wide rows by digest (C5, A2): whole rows move only where they may repeat.

A first pass shuffles 64-bit digests and keeps those that several rows share. Rows whose
digest is alone are unique and stay where they are; the others are compared column by
column, so a clash of digests cannot lose a row. Where most rows repeat, or rows are hardly
wider than a digest, plain grouping (``dropDuplicates``) moves no more and reads the input
once instead of twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import col, is_float_type
from tabsmith.session import cut_lineage

BROADCAST_DIGESTS = 1_000_000       # shared digests up to this many (8 MB) are broadcast
_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def row_digest(df: DataFrame) -> Column:
    """The same for rows that are equal as groups: nulls by place, -0.0 as 0.0."""
    parts = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, _NESTED):
            raise TypeError(f"column {f.name}: digests are of plain columns; use dropDuplicates")
        parts += [c.isNull(), F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c) if is_float_type(f.dataType) else c]
    return F.xxhash64(*parts)


def split_by_digest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are certainly unique, rows that share their digest with another one)."""
    marked = df.withColumn("_digest", row_digest(df))
    shared = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
    shared = cut_lineage(shared)                         # one row a repeated digest, read twice
    if shared.count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    return marked.join(shared, "_digest", "left_anti").drop("_digest"), marked.join(shared, "_digest", "left_semi").drop("_digest")


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row of every group of equal rows."""
    alone, several = split_by_digest(df)
    return alone.unionByName(several.dropDuplicates())


def surplus_rows(df: DataFrame) -> DataFrame:
    """A2: ``n_duplicate_rows``, the rows beyond the first of every group of equal rows."""
    _, several = split_by_digest(df)
    groups = several.groupBy(*[col(c) for c in several.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))
