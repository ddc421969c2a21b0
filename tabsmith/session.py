"""Spark session and shared-folder helpers.

The library never creates machine-local scratch folders on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``. Only where that setting is absent and the master is local
(tests) is it pointed at a fresh temporary folder; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app_name: str = "tabsmith",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build one tuned for this library.

    Settings that matter at scale: AQE (coalescing and skew-join splitting), UTC
    session time zone (parity with other engines), Arrow for pandas interchange and
    no web UI.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the session. Where it is unset a local master gets a
    temporary folder (tests); a cluster raises, as its machines do not share one."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
    else:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabsmith-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and return the re-read frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


# Logical operators whose output is already shuffle-partitioned (or whose partition count
# would need execution to learn under AQE).
_SHUFFLED = ("Join", "Aggregate", "Window", "Repartition", "Sort", "Union", "Expand", "Deduplicate",
             "Sample", "Limit", "Distinct", "Intersect", "Except", "LocalRelation", "LogicalRDD")


def _scan_partitions(df: DataFrame) -> int | None:
    """Partition count of a plain scan (project/filter/generate over files), else None.

    Asking a plan with shuffles for its RDD would run its stages under AQE, so those
    plans are not inspected: their partitioning comes from the shuffle anyway.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan().treeString()
    except Exception:  # noqa: BLE001
        return None
    nodes = {line.strip(" :+-!").split(" ")[0] for line in plan.splitlines() if line.strip()}
    if any(n.startswith(_SHUFFLED) for n in nodes):
        return None
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - streaming or unsupported plans
        return None


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an under-partitioned input over the cluster's cores.

    A small file with one row group is read by one task; CPU-heavy aggregates then run
    single-threaded. On real inputs (many files/row groups) the scan already has at
    least as many partitions as cores and this is a no-op (no extra shuffle).
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    have = _scan_partitions(df)
    return df.repartition(want) if have is not None and have < want else df


@contextmanager
def materialized(df: DataFrame):
    """Context for operators that make several passes over an under-partitioned input.

    When ``spread`` would repartition, the spread copy is persisted (memory, then disk)
    for the passes and released on exit; a lost block is recomputed from lineage. On
    inputs that already have enough partitions the frame is used as is (no cache).
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    have = _scan_partitions(df)
    if have is None or have >= want:
        yield df
        return
    from pyspark import StorageLevel

    cached = df.repartition(want).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
