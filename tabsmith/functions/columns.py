"""Column helpers: quoting, type families, missing-value and text predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Both ends, all Unicode white space, plus the four ASCII separators U+001C..U+001F that
# Python's str.strip() also removes.
_STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def quote(name: str) -> str:
    """Backtick-quote a column name so `-`, `.`, `(`, `&` and blanks resolve literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_string_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.CharType, T.VarcharType))


def is_float_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Columns of the numeric family (integral, fractional, decimal)."""
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """String-family columns minus ``exclude`` (e.g. the target)."""
    return [f.name for f in df.schema.fields if is_string_type(f.dataType) and f.name not in exclude]


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def strip_text(c: Column) -> Column:
    """Strip Unicode white space at both ends (``F.trim`` only removes U+0020)."""
    return F.regexp_replace(c, _STRIP_PATTERN, "")


def is_missing(c: Column, dt: T.DataType) -> Column:
    """Null, or NaN for floating columns (pandas' notion of missing)."""
    if is_float_type(dt):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def as_value(c: Column, dt: T.DataType) -> Column:
    """Normalise NaN to null so aggregates ignore it like pandas does."""
    if is_float_type(dt):
        return F.nanvl(c, F.lit(None).cast(dt))
    return c


def numeric_value(name: str, df: DataFrame) -> Column:
    """Numeric column as double with NaN mapped to null (input to moments/quantiles)."""
    dt = dtype_of(df, name)
    return as_value(col(name), dt).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null instead of raising under ANSI mode."""
    return F.try_divide(num, den)


def percent(part: Column, whole: Column) -> Column:
    """Percentage as a number (``part / whole * 100``), null on empty input."""
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))


def round_half_up(c: Column, digits: int) -> Column:
    """Report-layer rounding; operators return full precision."""
    return F.round(c, digits)
