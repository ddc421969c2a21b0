"""Physical-plan properties that matter at scale (checked on the executed plan)."""

import os

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import frequency, profile
from tabsmith.operators.split import assign_split
from tabsmith.sources.loaders import apply_null_tokens

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_uses_partial_window_group_limit(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    plan = _plan(frequency.top_levels(frequency.frequency_table(part, ["p_brand", "p_type"]), 5))
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


def test_profile_reads_only_profiled_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = frequency.unpivot_values(li, ["l_quantity", "l_tax"], "double").groupBy("column").count()
    plan = _plan(df)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_quantity" in scan and "l_tax" in scan and "l_extendedprice" not in scan


def test_filters_reach_the_scan_through_the_loader(spark):
    orders = apply_null_tokens(spark.read.parquet(f"{SF}/orders.parquet"), ["4-NOT SPECIFIED"])
    plan = _plan(orders.where(F.col("o_orderkey") < 100).select("o_orderkey", "o_orderpriority"))
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in plan


def test_split_assignment_does_not_shuffle_the_table(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    plan = _plan(assign_split(li, 0.2, 42, "l_returnflag", key))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_outlier_count_is_one_pass_over_all_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _plan(profile.outlier_summary(li, ["l_quantity", "l_extendedprice", "l_discount"]))
    assert plan.count("FileScan parquet") == 1


def test_model_comparison_is_one_scan_and_one_aggregate(spark):
    from tabsmith.operators.evaluate import model_confusion, model_metrics

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    scored = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                       (F.col("l_discount") >= 0.05).cast("int").alias("a"),
                       (F.col("l_quantity") > 25).cast("int").alias("b"),
                       (F.col("l_tax") < 0.04).cast("int").alias("c"))
    for df in (model_metrics(scored, "label", ["a", "b", "c"]), model_confusion(scored, "label", ["a", "b"])):
        plan = _plan(df)
        assert plan.count("FileScan parquet") == 1          # every model in the same pass
        assert "hashpartitioning" not in plan                # no per-model grouping shuffle
        scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
        assert "l_extendedprice" not in scan                 # pruned to the used columns


def test_two_level_blocks_broadcast_only_the_split_points(spark):
    from tabsmith.operators import ranking

    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    plan = _plan(ranking.two_level_blocks(li, ["l_orderkey", "l_linenumber"], 40, 6000, coarse_max=4, name="blk"))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
