"""Cleaning steps (C1-C8, P1): plain ``DataFrame -> DataFrame`` callables.

Each step is usable with ``df.transform(step)``; a pipeline is a left fold. The mode
imputer is a fit/transform pair so held-out data reuses the modes learned on train.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tabsmith.functions.columns import col, dtype_of, is_missing

CleaningStep = Callable[[DataFrame], DataFrame]


class DropColumns:
    """Drop columns; absent names are ignored."""

    def __init__(self, columns: Iterable[str]) -> None:
        self.columns = list(columns)

    def __call__(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.columns if c in df.columns]
        return df.drop(*present) if present else df


def _mode_by_type(df: DataFrame, columns: list[str]) -> list[DataFrame]:
    """One ``(column, value)`` frame per value type: the winner of each column.

    Columns of one type are unpivoted together and counted in one shuffle; the winner
    per column is ``min(struct(-cnt, value))`` - an ordinary partial aggregate, so a
    high-cardinality column never builds a value map inside one task, and a value that
    holds a third of all rows is one partial row per task. Ties -> smallest value in
    the column's own order.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(dtype_of(df, c).simpleString(), []).append(c)
    frames = []
    for names in by_type.values():
        cells = F.array(*[
            F.struct(F.lit(c).alias("column"),
                     F.when(~is_missing(col(c), dtype_of(df, c)), col(c)).alias("value"))
            for c in names
        ])
        freq = df.select(F.inline(cells)).where(F.col("value").isNotNull()) \
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        best = freq.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("k"), F.col("value"))).alias("m"))
        frames.append(best.select("column", F.col("m.value").alias("value"), (-F.col("m.k")).alias("cnt")))
    return frames


def mode_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """C3 as a lazy table: ``(column, value, cnt)`` per column, value as text.

    All-missing columns have no row. Nothing is collected.
    """
    columns = list(columns) if columns is not None else list(df.columns)
    if not columns:
        raise ValueError("no columns")
    frames = [f.select("column", F.col("value").cast("string").alias("value"), "cnt")
              for f in _mode_by_type(df, columns)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def mode_values(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-missing value per column, ties -> smallest value.

    Values keep their column's type; all-missing columns map to None. The driver
    receives one row per column.
    """
    if not columns:
        return {}
    result: dict[str, object] = {c: None for c in columns}
    for best in _mode_by_type(df, columns):
        for r in best.collect():
            result[r["column"]] = r["value"]
    return result


class ModeImputerModel:
    """C2 transform: fill missing values of each column with its learned mode (C4)."""

    def __init__(self, modes: dict[str, object]) -> None:
        self.modes = modes

    def __call__(self, df: DataFrame) -> DataFrame:
        fills = {c: v for c, v in self.modes.items() if c in df.columns and v is not None}
        if not fills:
            return df
        return df.select(*[
            F.when(is_missing(col(c), dtype_of(df, c)), F.lit(fills[c]).cast(dtype_of(df, c)))
            .otherwise(col(c)).alias(c) if c in fills else col(c)
            for c in df.columns
        ])

    transform = __call__


class ModeImputer:
    """Impute listed columns with their mode; absent columns are skipped.

    Calling the step fits on the frame it is given (the reference's behaviour);
    ``fit`` returns a model to apply the same modes elsewhere. An all-missing column
    stays missing (the reference crashes there).
    """

    def __init__(self, columns: Iterable[str]) -> None:
        self.columns = list(columns)

    def fit(self, df: DataFrame) -> ModeImputerModel:
        present = [c for c in self.columns if c in df.columns]
        return ModeImputerModel(mode_values(df, present))

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.fit(df)(df)


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    """C4: replace missing values of one column with a constant."""
    filler = F.lit(value).cast(dtype_of(df, column))
    return df.withColumn(column, F.when(is_missing(col(column), dtype_of(df, column)), filler).otherwise(col(column)))


class DropDuplicateRows:
    """Remove full-row duplicates, keeping one of each group.

    Null equals null, NaN equals NaN and -0.0 equals 0.0 (Spark normalises floating
    keys). With ``observe=True`` the rows in and out are counted as a side effect of
    the next action (``removed`` reads them) - no extra job.
    """

    def __init__(self, observe: bool = False) -> None:
        self.observe = observe
        self._in: Observation | None = None
        self._out: Observation | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        from tabsmith.operators.quality import _groupable

        _groupable(df)
        if not self.observe:
            return df.dropDuplicates()
        self._in, self._out = Observation("dedup_in"), Observation("dedup_out")
        src = df.observe(self._in, F.count(F.lit(1)).alias("n"))
        return src.dropDuplicates().observe(self._out, F.count(F.lit(1)).alias("n"))

    @property
    def removed(self) -> int | None:
        if self._in is None or self._out is None:
            return None
        return int(self._in.get["n"]) - int(self._out.get["n"])


class CleaningPipeline:
    """Apply steps in order; no steps is the identity."""

    def __init__(self, steps: Iterable[CleaningStep]) -> None:
        self.steps = list(steps)

    def run(self, df: DataFrame) -> DataFrame:
        return reduce(lambda acc, step: acc.transform(step), self.steps, df)

    __call__ = run


def default_recipe(drop: Iterable[str], impute: Iterable[str]) -> CleaningPipeline:
    """Drop -> impute -> dedup, in that order (dedup sees the imputed rows)."""
    return CleaningPipeline([DropColumns(drop), ModeImputer(impute), DropDuplicateRows()])
