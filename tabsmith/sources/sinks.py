"""Sinks (S9, S10, S12, S13, S15): executors write; nothing passes through the driver."""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.columns import col, round_half_up


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Parquet by default; ``fmt="csv"`` writes a header row (the reference's format)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_split_table(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One dataset partitioned by the split marker, label kept inside; readers of
    ``split='train'`` prune the other partition."""
    write_table(df, path, partition_by=[split_col])


def export_four_files(df: DataFrame, out_dir: str, label: str, key: list[str], split_col: str = "split",
                      fmt: str = "csv") -> dict[str, str]:
    """S10 (reference layout): features / labels / test_features / test_labels, each
    sorted by ``key`` so the feature and label files line up row by row (J1)."""
    features = [c for c in df.columns if c not in (label, split_col)]
    paths = {}
    for side, prefix in (("train", ""), ("test", "test_")):
        part = df.where(F.col(split_col) == side).orderBy(*[col(k) for k in key])
        paths[f"{prefix}features"] = os.path.join(out_dir, f"{prefix}features")
        paths[f"{prefix}labels"] = os.path.join(out_dir, f"{prefix}labels")
        write_table(part.select(*[col(c) for c in features]), paths[f"{prefix}features"], fmt)
        write_table(part.select(*[col(k) for k in key], col(label)), paths[f"{prefix}labels"], fmt)
    return paths


def write_predictions(pred: DataFrame, path: str, key: list[str], with_probability: bool = True) -> None:
    """Key columns + prediction (+ probability); row order is not a contract."""
    cols = [*key, "prediction"] + (["p1"] if with_probability and "p1" in pred.columns else [])
    write_table(pred.select(*[col(c) for c in cols]), path)


def save_model(model: PipelineModel, path: str) -> None:
    """The whole bundle (scaler + assembler + classifier) as one PipelineModel."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet", digits: int | None = None) -> dict[str, str]:
    """Each report section as its own table; some (category counts) grow with the data.
    ``digits`` (X5) rounds the doubles of the report; without it they keep full precision."""
    paths = {}
    for name, frame in tables.items():
        if digits is not None:
            frame = frame.select(*[round_half_up(col(c), digits).alias(c) if t == "double" else col(c) for c, t in frame.dtypes])
        paths[name] = os.path.join(out_dir, name)
        write_table(frame, paths[name], fmt)
    return paths
