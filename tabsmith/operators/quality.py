"""Data-quality aggregates (A1-A6): one wide aggregate per question, stacked to long rows.

Every statistic for every column is computed in a single aggregate (partial on the map
side, one tiny final row) and turned into rows with ``inline`` - no per-column jobs,
no collect. Only the duplicate count needs its own ``groupBy`` over all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import as_value, col, is_missing, percent, quote
from tabsmith.operators.frequency import frequency_table


def _stack(one_row: DataFrame, entries: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """Turn a one-row frame of ``<field>`` columns into one row per entry."""
    structs = []
    for name, fields in entries:
        parts = [F.lit(name).alias("column")] + [F.col(src).alias(dst) for dst, src in fields.items()]
        structs.append(F.struct(*parts))
    return one_row.select(F.inline(F.array(*structs)))


def missing_counts(df: DataFrame) -> DataFrame:
    """``(column, missing_count, missing_pct)`` for every column (A1 before the filter, A17)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(is_missing(col(f.name), f.dataType)).alias(f"m{i}") for i, f in enumerate(fields)]
    row = df.agg(*aggs)
    long = _stack(row, [(f.name, {"missing_count": f"m{i}", "_rows": "_rows"}) for i, f in enumerate(fields)])
    return long.select("column", "missing_count",
                       percent(F.col("missing_count"), F.col("_rows")).alias("missing_pct"))


def missing_count(df: DataFrame, column: str) -> DataFrame:
    """``(column, missing_count, missing_pct)`` of one column (null, or NaN for floats)."""
    return missing_counts(df.select(col(column)))


def missing_values_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, count desc then name."""
    return missing_counts(df).where("missing_count > 0").orderBy(F.desc("missing_count"), "column")


def _groupable(df: DataFrame) -> None:
    bad = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if bad:
        raise TypeError(f"map columns cannot be compared for duplicates: {bad}")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """A2: one row ``n_duplicate_rows`` = rows beyond the first of each identical group.

    One ``groupBy`` over all columns; the map side pre-counts, so a row repeated a
    billion times is one partial row per task.
    """
    _groupable(df)
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))


def duplicate_rows_count(df: DataFrame) -> int:
    return int(duplicate_rows(df).first()["n_duplicate_rows"])


def cardinality_report(df: DataFrame, columns: list[str] | None = None, approx_rsd: float | None = None) -> DataFrame:
    """A3: ``(column, unique_values)`` per string column, missing excluded, desc.

    Exact by default from the frequency table (one shuffle); ``approx_rsd`` switches to
    HyperLogLog++ in a single aggregate with no shuffle of values.
    """
    from tabsmith.functions.columns import categorical_columns

    columns = columns if columns is not None else categorical_columns(df)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    if approx_rsd is not None:
        row = df.agg(*[F.approx_count_distinct(col(c), approx_rsd).alias(f"d{i}") for i, c in enumerate(columns)])
        out = _stack(row, [(c, {"unique_values": f"d{i}"}) for i, c in enumerate(columns)])
    else:
        counts = frequency_table(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
        out = names.join(counts, "column", "left").select(
            "column", F.coalesce("unique_values", F.lit(0)).cast("long").alias("unique_values"))
    return out.orderBy(F.desc("unique_values"), "column")


def _orderable(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.MapType, T.VariantType)) if hasattr(T, "VariantType") else not isinstance(dt, T.MapType)


def constant_report(df: DataFrame) -> DataFrame:
    """A4: ``(column, is_constant)``; constant = at most one distinct non-missing value.

    ``min <=> max`` needs no distinct aggregate (one pass, partial); all-missing columns
    count as constant. Map columns fall back to an exact distinct count of their JSON.
    """
    aggs, entries = [], []
    for i, f in enumerate(df.schema.fields):
        v = as_value(col(f.name), f.dataType)
        if _orderable(f.dataType):
            aggs.append(F.min(v).eqNullSafe(F.max(v)).alias(f"k{i}"))
        else:
            aggs.append((F.count_distinct(F.to_json(v)) <= 1).alias(f"k{i}"))
        entries.append((f.name, {"is_constant": f"k{i}"}))
    return _stack(df.agg(*aggs), entries)


def constant_columns(df: DataFrame) -> list[str]:
    rows = constant_report(df).where("is_constant").collect()
    order = {c: i for i, c in enumerate(df.columns)}
    return sorted((r["column"] for r in rows), key=order.get)


def summary(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_columns, n_duplicate_rows, columns_with_missing,
    constant_columns`` (the two lists in column order)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, f in enumerate(fields):
        v = as_value(col(f.name), f.dataType)
        aggs.append(F.count_if(is_missing(col(f.name), f.dataType)).alias(f"m{i}"))
        if _orderable(f.dataType):
            aggs.append(F.min(v).eqNullSafe(F.max(v)).alias(f"k{i}"))
        else:
            aggs.append((F.count_distinct(F.to_json(v)) <= 1).alias(f"k{i}"))
    wide = df.agg(*aggs)
    missing = F.filter(F.array(*[F.when(F.col(f"m{i}") > 0, F.lit(f.name)) for i, f in enumerate(fields)]),
                       lambda x: x.isNotNull())
    constant = F.filter(F.array(*[F.when(F.col(f"k{i}"), F.lit(f.name)) for i, f in enumerate(fields)]),
                        lambda x: x.isNotNull())
    dups = duplicate_rows_count(df)
    return wide.select("n_rows", F.lit(len(fields)).alias("n_columns"), F.lit(dups).cast("long").alias("n_duplicate_rows"),
                       missing.alias("columns_with_missing"), constant.alias("constant_columns"))


__all__ = [
    "missing_counts", "missing_values_report", "duplicate_rows", "duplicate_rows_count",
    "cardinality_report", "constant_report", "constant_columns", "summary", "quote",
]
