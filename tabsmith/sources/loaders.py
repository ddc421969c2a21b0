"""Sources (S1-S8): CSV, Parquet, catalog table or an existing DataFrame.

The CSV path reproduces the reference loader's text rules on executors:
header names stripped, leading blanks skipped, a list of null tokens compared *before*
the final strip (so ``"? "`` with a trailing blank is a value), string values stripped
of Unicode white space, then per-column type inference in ONE aggregate pass over
guarded trial casts. At scale, pass an explicit ``schema`` and skip inference.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tabsmith.functions.columns import col, is_string_type, quote, strip_text
from tabsmith.sources.quoted import quoted_records

# The null tokens pandas' read_csv recognises by default (keep_default_na).
PANDAS_DEFAULT_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The reference's extra tokens for the census file.
CENSUS_NULL_TOKENS = (" ?", "?")

# Guards that make Spark's trial casts as strict as a text reader: Spark alone accepts
# '1d' as a double and 'yes' / '1' as a boolean.
_INT_RE = r"^[+-]?[0-9]+$"
_FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Inf|INF|infinity|Infinity)$"
_BOOL_TRUE = ("True", "TRUE", "true")
_BOOL_FALSE = ("False", "FALSE", "false")


class DataLoader(ABC):
    """Pluggable source; ``load`` returns a lazy DataFrame."""

    @abstractmethod
    def load(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError


def _check_path(spark: SparkSession, path: str) -> None:
    """Raise FileNotFoundError for a missing path, using the path's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(f"input not found: {path}")


def apply_null_tokens(df: DataFrame, tokens: Iterable[str], columns: list[str] | None = None) -> DataFrame:
    """S3: any string field equal to a token becomes null (one projection)."""
    tokens = list(tokens)
    names = columns if columns is not None else [f.name for f in df.schema.fields if is_string_type(f.dataType)]
    if not tokens or not names:
        return df
    targets = set(names)
    return df.select(*[
        F.when(col(c).isin(tokens), F.lit(None).cast("string")).otherwise(col(c)).alias(c)
        if c in targets else col(c)
        for c in df.columns
    ])


def strip_header(df: DataFrame) -> DataFrame:
    """Strip blanks around every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def strip_string_values(df: DataFrame) -> DataFrame:
    """Strip Unicode white space from every string column, in one projection."""
    return df.select(*[
        strip_text(col(f.name)).alias(f.name) if is_string_type(f.dataType) else col(f.name)
        for f in df.schema.fields
    ])


def _bool_expr(c: Column) -> Column:
    return F.when(c.isin(*_BOOL_TRUE), F.lit(True)).when(c.isin(*_BOOL_FALSE), F.lit(False))


def infer_types(df: DataFrame) -> DataFrame:
    """Per string column choose bigint -> double -> boolean -> string, like a text reader.

    One aggregate over all columns decides every type (partial aggregation, one tiny
    result row); a second projection applies the casts. All-null columns become double.
    """
    names = [f.name for f in df.schema.fields if is_string_type(f.dataType)]
    if not names:
        return df
    checks = []
    for i, name in enumerate(names):
        c = col(name)
        present = c.isNotNull()
        checks += [
            F.bool_and(~present | (c.rlike(_INT_RE) & c.try_cast("bigint").isNotNull())).alias(f"i{i}"),
            F.bool_and(~present | c.rlike(_FLOAT_RE) | c.isin("nan", "NaN", "-nan", "-NaN")).alias(f"f{i}"),
            F.bool_and(~present | c.isin(*_BOOL_TRUE, *_BOOL_FALSE)).alias(f"b{i}"),
            F.count(c).alias(f"n{i}"),
        ]
    verdict = df.agg(*checks).first()
    casts = {}
    for i, name in enumerate(names):
        if verdict[f"n{i}"] == 0:
            casts[name] = F.lit(None).cast("double")
        elif verdict[f"i{i}"]:
            casts[name] = col(name).try_cast("bigint")
        elif verdict[f"f{i}"]:
            casts[name] = col(name).try_cast("double")
        elif verdict[f"b{i}"]:
            casts[name] = _bool_expr(col(name))
    return df.select(*[casts[c].alias(c) if c in casts else col(c) for c in df.columns])


_RECORD = "__whole_record"


class CSVDataLoader(DataLoader):
    """CSV scan with the reference loader's text rules.

    A line with more fields than the header raises; one with fewer ends in missing values.
    Files are split among tasks by byte ranges. ``multi_line`` allows line breaks in quotes
    (:mod:`tabsmith.sources.quoted`, two passes over the text); turn it off for files without.

    ``schema`` (a DDL string or StructType) skips inference and is what to use at scale;
    without it every column is read as text and typed by :func:`infer_types`.
    """

    def __init__(self, path: str, null_tokens: Iterable[str] = CENSUS_NULL_TOKENS,
                 default_null_tokens: bool = True, strip_whitespace: bool = True,
                 schema: T.StructType | str | None = None, sep: str = ",", multi_line: bool = True) -> None:
        self.path = path
        tokens = list(null_tokens)
        if default_null_tokens:
            tokens += [t for t in PANDAS_DEFAULT_NULL_TOKENS if t not in tokens]
        self.null_tokens = tokens
        self.strip_whitespace = strip_whitespace
        self.schema = schema
        self.sep = sep
        self.multi_line = multi_line

    def _read_text(self, spark: SparkSession) -> DataFrame:
        options = {
            "sep": self.sep, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "false",
            # keep empty fields as "" so the token list decides what is missing
            "nullValue": "\u0000__never__", "emptyValue": "",
            # quotes inside quotes are doubled, and quoted text may hold line breaks
            "escape": '"', "multiLine": str(self.multi_line).lower(), "mode": "PERMISSIVE",
        }
        reader = spark.read.options(**options).option("header", True).option("inferSchema", False)
        header = reader.csv(self.path).schema
        if not header.fields:
            return reader.csv(self.path)
        whole = T.StructType([*header.fields, T.StructField(_RECORD, T.StringType())])
        options["columnNameOfCorruptRecord"] = _RECORD
        if self.multi_line:
            # field names do not matter to the parser: numbered ones need no quoting
            plain = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header.fields))] + [whole.fields[-1]])
            parsed = F.from_csv("record", plain.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
            df = quoted_records(spark, self.path, self.sep).select(parsed.alias("r")).select("r.*").toDF(*whole.names)
        else:
            df = reader.schema(whole).options(**options).csv(self.path)
        # a line with too few fields has nulls at its end; one with too many has none
        surplus = F.col(_RECORD).isNotNull() & col(header.fields[-1].name).isNotNull()
        fails = F.raise_error(F.concat(F.lit("more fields than the header: "), F.col(_RECORD))).cast("boolean")
        return df.where(F.when(surplus, fails).otherwise(F.lit(True))).drop(_RECORD)

    def load(self, spark: SparkSession) -> DataFrame:
        _check_path(spark, self.path)
        df = strip_header(self._read_text(spark))
        df = apply_null_tokens(df, self.null_tokens)
        if self.strip_whitespace:
            df = strip_string_values(df)
        if self.schema is None:
            return infer_types(df)
        target = self.schema if isinstance(self.schema, T.StructType) else T._parse_datatype_string(self.schema)
        return df.select(*[
            col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ])


class ParquetLoader(DataLoader):
    """Parquet scan: filters and projections applied later reach the file scan."""

    def __init__(self, path: str, columns: list[str] | None = None) -> None:
        self.path = path
        self.columns = columns

    def load(self, spark: SparkSession) -> DataFrame:
        _check_path(spark, self.path)
        df = spark.read.parquet(self.path)
        return df.select(*[quote(c) for c in self.columns]) if self.columns else df


class TableLoader(DataLoader):
    """Catalog table or view by name."""

    def __init__(self, name: str) -> None:
        self.name = name

    def load(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.table(self.name)
        except AnalysisException as exc:  # S7 for tables
            raise FileNotFoundError(f"table not found: {self.name}") from exc


class FrameLoader(DataLoader):
    """An existing DataFrame (tests, or a frame built upstream)."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def load(self, spark: SparkSession) -> DataFrame:
        return self.df


def with_load_counts(df: DataFrame, name: str = "load"):
    """Attach an observation of the row count; read it after the first action.

    Returns ``(df, observation)``; ``observation.get`` holds ``{"rows": n}`` once any
    action has run. No extra job is triggered.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
