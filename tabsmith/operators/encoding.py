"""Target and categorical encoders (F1-F5, P8) as Spark ML stages.

The fitted one-hot levels live in a Param, so the model saves and loads inside a
``PipelineModel`` with the scaler and the classifier. Levels are read from the
frequency table (one shuffle, map-side counted) and are bounded by ``max_levels``;
above it use :func:`vector_one_hot`, which never brings levels to the driver.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorSlicer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.columns import categorical_columns, col, strip_text
from tabsmith.operators.frequency import frequency_table


class BinaryTargetEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``strip(str(v)) == positive_label`` -> 1 else 0; missing -> 0.

    Same output name replaces the column in place; another name is appended last and
    the source column dropped (P8).
    """

    column = Param(Params._dummy(), "column", "target column", TypeConverters.toString)
    positiveLabel = Param(Params._dummy(), "positiveLabel", "value mapped to 1", TypeConverters.toString)
    outputColumn = Param(Params._dummy(), "outputColumn", "output column", TypeConverters.toString)

    @keyword_only
    def __init__(self, column: str = "salary", positiveLabel: str = ">50K", outputColumn: str | None = None):
        super().__init__()
        self._setDefault(column="salary", positiveLabel=">50K")
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        src = self.getOrDefault(self.column)
        out = self.getOrDefault(self.outputColumn) if self.isDefined(self.outputColumn) else src
        dt = df.schema[src].dataType
        text = col(src).cast("string")
        if isinstance(dt, T.BooleanType):  # Python prints booleans capitalised
            text = F.when(col(src), F.lit("True")).when(~col(src), F.lit("False"))
        label = F.coalesce(strip_text(text) == F.lit(self.getOrDefault(self.positiveLabel)), F.lit(False)).cast("int")
        if out == src:
            return df.withColumn(src, label)
        return df.withColumn(out, label).drop(src)


def _dummy_name(column: str, level: str) -> str:
    return f"{column}_{level}"


class OneHotModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """F2 transform: untouched columns first, then per column one 0/1 column per kept
    level (``column_level``), built in a single ``select``. Missing and unseen levels
    give all zeros (F5)."""

    levels = Param(Params._dummy(), "levels", "JSON {column: [levels...]} in output order",
                   TypeConverters.toString)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the smallest level", TypeConverters.toBoolean)
    dtype = Param(Params._dummy(), "dtype", "type of the dummy columns", TypeConverters.toString)

    def __init__(self, levels: str = "{}", dropFirst: bool = True, dtype: str = "int"):
        super().__init__()
        self._set(levels=levels, dropFirst=dropFirst, dtype=dtype)

    @property
    def categorical_columns_(self) -> list[str]:
        return list(json.loads(self.getOrDefault(self.levels)).keys())

    @property
    def encoded_columns_(self) -> list[str]:
        """names of the dummy columns, in output order."""
        out = []
        drop = self.getOrDefault(self.dropFirst)
        for c, lv in json.loads(self.getOrDefault(self.levels)).items():
            out += [_dummy_name(c, v) for v in (lv[1:] if drop else lv)]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        levels = json.loads(self.getOrDefault(self.levels))
        drop = self.getOrDefault(self.dropFirst)
        dtype = self.getOrDefault(self.dtype)
        keep = [col(c) for c in df.columns if c not in levels]
        dummies = []
        for c, lv in levels.items():
            for v in (lv[1:] if drop else lv):
                dummies.append(F.when(col(c) == F.lit(v), 1).otherwise(0).cast(dtype).alias(_dummy_name(c, v)))
        return df.select(*keep, *dummies)


class OneHotCategoricalEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """one-hot every string column except ``exclude``; levels sorted by code point.

    Every level becomes a column, so the levels are brought to the driver; a column with
    very many is a case for :func:`vector_one_hot`. ``maxLevels`` makes that an error.
    """

    exclude = Param(Params._dummy(), "exclude", "columns never encoded", TypeConverters.toListString)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the smallest level", TypeConverters.toBoolean)
    dtype = Param(Params._dummy(), "dtype", "type of the dummy columns", TypeConverters.toString)
    maxLevels = Param(Params._dummy(), "maxLevels", "error beyond so many levels a column (0: no limit)",
                      TypeConverters.toInt)

    @keyword_only
    def __init__(self, exclude: list[str] | None = None, dropFirst: bool = True, dtype: str = "int",
                 maxLevels: int = 0):
        super().__init__()
        self._setDefault(exclude=[], dropFirst=True, dtype="int", maxLevels=0)
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> OneHotModel:
        cats = categorical_columns(df, exclude=self.getOrDefault(self.exclude))
        limit = self.getOrDefault(self.maxLevels)
        levels: dict[str, list[str]] = {c: [] for c in cats}
        if cats:
            freq = frequency_table(df, cats)
            per_col = freq.groupBy("column").agg(F.count(F.lit(1)).alias("k"))
            too_many = per_col.where(F.col("k") > limit).collect() if limit else []
            if too_many:
                raise ValueError(f"columns exceed maxLevels={limit}: {[r['column'] for r in too_many]}; "
                                 "use vector_one_hot for high cardinality")
            for r in freq.select("column", "value").collect():
                levels[r["column"]].append(r["value"])
        ordered = {c: sorted(v) for c, v in levels.items()}
        return OneHotModel(levels=json.dumps(ordered), dropFirst=self.getOrDefault(self.dropFirst),
                           dtype=self.getOrDefault(self.dtype))


def vector_one_hot(columns: list[str], drop_first: bool = True, output_col: str = "onehot") -> list:
    """high-cardinality one-hot as a sparse vector, levels never collected.

    ``StringIndexer(alphabetAsc, keep)`` numbers levels in code-point order and sends
    null/unseen to an extra slot that ``dropLast`` removes (all zeros, like F2);
    slicing off index 0 of each vector drops the smallest level.
    """
    idx = [f"{c}__idx" for c in columns]
    vec = [f"{c}__vec" for c in columns]
    stages = [
        StringIndexer(inputCols=columns, outputCols=idx, stringOrderType="alphabetAsc", handleInvalid="keep"),
        # the indexer's extra (null/unseen) index is the LAST category, which dropLast removes
        OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True),
    ]
    if drop_first:
        sliced = []
        for v in vec:
            stages.append(_DropFirstSlot(inputCol=v, outputCol=f"{v}__s"))
            sliced.append(f"{v}__s")
        vec = sliced
    from pyspark.ml.feature import VectorAssembler

    stages.append(VectorAssembler(inputCols=vec, outputCol=output_col))
    return stages


class _DropFirstSlot(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Remove slot 0 of a vector column (size read from the vector's metadata at run time)."""

    inputCol = Param(Params._dummy(), "inputCol", "input", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        src = self.getOrDefault(self.inputCol)
        meta = df.schema[src].metadata.get("ml_attr", {})
        size = int(meta.get("num_attrs", 0))
        if size <= 1:
            from pyspark.ml.functions import array_to_vector

            return df.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.array().cast("array<double>")))
        return VectorSlicer(inputCol=src, outputCol=self.getOrDefault(self.outputCol),
                            indices=list(range(1, size))).transform(df)
