"""The long frequency table shared by A3, A10, A16, C3, V4, V6 and the one-hot levels (F2).

``unpivot`` the chosen columns into ``(column, value)`` and count with one ``groupBy``:
one shuffle whose map side pre-aggregates, so a value that holds a third of all rows
costs one partial row per task, not a hot reducer. No ``Expand`` of distinct aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.columns import as_value, categorical_columns, col, dtype_of


def unpivot_values(df: DataFrame, columns: list[str], value_type: str = "string") -> DataFrame:
    """``(column, value)`` rows for the listed columns, nulls/NaN dropped."""
    if not columns:
        raise ValueError("no columns to unpivot")
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), as_value(col(c), dtype_of(df, c)).cast(value_type).alias("value"))
        for c in columns
    ])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull())


def frequency_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, value, cnt)``: count of every non-missing level of every column."""
    columns = columns if columns is not None else categorical_columns(df)
    return unpivot_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def top_levels(freq: DataFrame, top_n: int) -> DataFrame:
    """A10/O2: top-N levels per column by count desc, value asc (``rank`` from 1).

    The ``rank <= N`` filter over ``row_number`` lets Spark plan a partial
    ``WindowGroupLimit`` before the exchange, so each task forwards at most N rows
    per column however many levels a column has.
    """
    w = Window.partitionBy("column").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def level_shares(df: DataFrame, column: str) -> DataFrame:
    """``(value, cnt, share)`` of one column; share over non-missing rows."""
    counts = frequency_table(df, [column]).select("value", "cnt")
    total = counts.agg(F.sum("cnt")).first()[0]     # one number
    return counts.select("value", "cnt", F.try_divide(F.col("cnt").cast("double"), F.lit(total)).alias("share"))
