"""C5 / A2 by digest: exact, also when digests clash, and far fewer bytes shuffled."""
import os

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import duplicates

ROWS = [(1, "a", 0.0), (1, "a", -0.0), (None, "a", 1.0), (1, None, 1.0), (None, "a", 1.0), (2, "b", float("nan")), (2, "b", float("nan")),
        (3, "c", None), (3, "c", 5.0), (None, None, None), (None, None, None), (None, None, None)]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ROWS, "k int, `a.b` string, x double")


def check(df):
    assert duplicates.distinct_rows(df).count() == df.dropDuplicates().count() == 7
    assert duplicates.distinct_rows(df).exceptAll(df.dropDuplicates()).count() == 0
    assert duplicates.surplus_rows(df).first()[0] == 5


def test_equal_rows_go_whatever_their_digest(odd, monkeypatch):
    check(odd)
    monkeypatch.setattr(duplicates, "BROADCAST_DIGESTS", 0)
    check(odd)
    monkeypatch.setattr(duplicates, "row_digest", lambda df: F.lit(7).cast("long"))     # every digest clashes
    check(odd)


def test_empty_and_nested(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert duplicates.distinct_rows(empty).count() == 0 and duplicates.surplus_rows(empty).first()[0] == 0
    with pytest.raises(TypeError):
        duplicates.distinct_rows(spark.range(2).select(F.array("id").alias("v")))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data absent")
def test_only_digests_are_shuffled_where_rows_are_unique(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    alone, several = duplicates.split_by_digest(li)
    assert alone.count() == li.count() and several.count() == 0
    plan = duplicates.distinct_rows(li)._jdf.queryExecution().executedPlan().toString()
    # the unique rows pass a broadcast join; the only exchange of whole rows is that of the candidates
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
