"""Pair a feature table with a label table by key, one row to one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.columns import col


def unpaired_keys(features: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """``(key..., n_features, n_labels)`` of every key that is not once in each table."""
    sides = [t.select(*[col(k) for k in key], F.lit(a).alias("_f"), F.lit(b).alias("_l"))
             for t, a, b in ((features, 1, 0), (labels, 0, 1))]
    counts = sides[0].union(sides[1]).groupBy(*[col(k) for k in key]).agg(F.sum("_f").alias("n_features"), F.sum("_l").alias("n_labels"))
    return counts.where("n_features <> 1 OR n_labels <> 1")


def pair_by_key(features: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Features with their labels. Raises where a key is missing on a side, repeats or is
    null: pairing by position would shift rows there without notice."""
    bad = unpaired_keys(features, labels, key).union(
        features.where(" OR ".join(f"`{k}` IS NULL" for k in key)).select(*[col(k) for k in key], F.lit(1), F.lit(0))).first()
    if bad is not None:
        raise ValueError(f"features and labels do not pair one to one, first at {bad.asDict()}")
    return features.join(labels, key)
