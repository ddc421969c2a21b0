"""Fitted preparation on streams.

Null tokens (S3), stripping (S5), constant fills (C4), the target encoder (F1), a
fitted one-hot model (F2), a fitted scaler (F7) and a fitted classifier pipeline (M4)
are row-wise maps with their state frozen at fit time, so they apply unchanged to a
streaming DataFrame; no stateful operator is involved. Fit on a batch snapshot, then
score the stream with a checkpointed sink (exactly-once file output).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def apply_fitted(stream: DataFrame, stages: Iterable) -> DataFrame:
    """Apply fitted stages (Transformers or ``DataFrame -> DataFrame`` callables) in order."""
    out = stream
    for stage in stages:
        out = stage.transform(out) if isinstance(stage, Transformer) else stage(out)
    return out


def score_stream(model, stream: DataFrame, out_path: str, checkpoint: str, key: list[str],
                 threshold: float = 0.5, trigger_once: bool = False) -> StreamingQuery:
    """Score a stream with a fitted PipelineModel into Parquet (append, checkpointed)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    scored = model.transform(stream)
    p1 = vector_to_array(F.col("probability"))[1]
    out = scored.select(*key, p1.alias("p1"), (p1 >= F.lit(threshold)).cast("int").alias("prediction"))
    writer = out.writeStream.format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
