import pytest
from pyspark.sql import functions as F

from tabsmith.operators.cleaning import (
    CleaningPipeline, DropColumns, DropDuplicateRows, ModeImputer, default_recipe, mode_values,
)
from tabsmith.operators.encoding import BinaryTargetEncoder, OneHotCategoricalEncoder, OneHotModel


def test_columns_are_dropped_where_they_exist(crates):
    assert DropColumns(["kilos", "colour"])(crates).columns == ["crate", "fruit", "farm", "state"]


def test_mode_fills_only_the_listed_column_and_leaves_its_input(crates):
    filled = {r["crate"]: (r["fruit"], r["farm"]) for r in ModeImputer(["farm"])(crates).collect()}
    assert filled == {1: ("apple", "north"), 2: ("pear", "north"), 3: (None, "north"), 4: ("plum", "south"), 5: ("pear", "north")}
    assert [r["crate"] for r in crates.where("farm IS NULL").collect()] == [2]


def test_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",)], "s string")
    assert mode_values(df, ["s"]) == {"s": "a"}


def test_all_missing_stays_missing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "s string, k int")
    out = ModeImputer(["s", "absent"])(df)
    assert out.where(F.col("s").isNull()).count() == 2


def test_numeric_mode_and_fit_transform(spark):
    train = spark.createDataFrame([(1.0,), (10.0,), (10.0,), (float("nan"),)], "x double")
    test = spark.createDataFrame([(None,), (3.0,)], "x double")
    model = ModeImputer(["x"]).fit(train)
    assert model.modes == {"x": 10.0}
    assert [r["x"] for r in model(test).collect()] == [10.0, 3.0]


def test_dedup_counts_what_it_removes(crates):
    step = DropDuplicateRows(observe=True)
    assert step(crates.unionByName(crates).unionByName(crates.limit(1))).count() == 5
    assert step.removed == 6


def test_pipeline_is_the_composition_of_its_steps(crates):
    drop, fill = DropColumns(["crate", "kilos"]), ModeImputer(["farm", "fruit"])
    got = sorted(map(tuple, CleaningPipeline([drop, fill]).run(crates).collect()))
    assert got == [("apple", "north", "ripe"), ("pear", "north", " ripe"), ("pear", "north", "green"),
                   ("pear", "north", "green"), ("plum", "south", "ripe")]
    assert CleaningPipeline([]).run(crates) is crates


def test_dedup_runs_after_impute(spark):
    df = spark.createDataFrame([("a", 1, 1), (None, 1, 2), ("a", 1, 3), ("a", 1, 4)], "s string, k int, w int")
    out = default_recipe(["w"], ["s"]).run(df)
    assert out.count() == 1


def test_target_ignores_padding_and_counts_missing_as_negative(spark, crates):
    encoder = BinaryTargetEncoder(column="state", positiveLabel="ripe")
    assert {r["crate"]: r["state"] for r in encoder.transform(crates).collect()} == {1: 1, 2: 0, 3: 0, 4: 1, 5: 1}
    named = BinaryTargetEncoder(column="state", positiveLabel="green", outputColumn="unripe").transform(crates)
    assert named.columns == ["crate", "kilos", "fruit", "farm", "unripe"]
    nulls = spark.createDataFrame([(None,), ("ripe",)], "state string")
    assert [r["state"] for r in encoder.transform(nulls).collect()] == [0, 1]


def test_one_hot_slots_by_hand(crates):
    levels = {"fruit_apple": [1, 0, 0, 0, 0], "fruit_pear": [0, 1, 0, 0, 1], "fruit_plum": [0, 0, 0, 1, 0],
              "farm_north": [1, 0, 1, 0, 1], "farm_south": [0, 0, 0, 1, 0]}
    for drop_first in (False, True):
        model = OneHotCategoricalEncoder(exclude=["state"], dropFirst=drop_first).fit(crates)
        rows = model.transform(crates).orderBy("crate").collect()
        names = [n for n in levels if not (drop_first and n in ("fruit_apple", "farm_north"))]
        assert set(rows[0].asDict()) == {"crate", "kilos", "state", *names}
        for name in names:  # a missing value has 0 in all its slots
            assert [r[name] for r in rows] == levels[name]


def test_odd_names_and_metadata_and_persistence(spark, tmp_path):
    df = spark.createDataFrame([("a-b", 1), ("c.d (e&f)", 2), (" ", 3)], "`odd col.name` string, k int")
    model = OneHotCategoricalEncoder(dropFirst=False).fit(df)
    out = model.transform(df)
    assert model.encoded_columns_ == ["odd col.name_ ", "odd col.name_a-b", "odd col.name_c.d (e&f)"]
    assert out.columns == ["k"] + model.encoded_columns_
    path = str(tmp_path / "ohe")
    model.write().overwrite().save(path)
    again = OneHotModel.load(path)
    assert again.transform(df).collect() == out.collect()


def test_one_level_with_drop_first_gives_no_column(spark):
    df = spark.createDataFrame([("x",), (None,)], "s string")
    assert OneHotCategoricalEncoder().fit(df).transform(df).columns == []


def test_max_levels_guard(spark):
    df = spark.createDataFrame([(str(i),) for i in range(10)], "s string")
    with pytest.raises(ValueError):
        OneHotCategoricalEncoder(maxLevels=5).fit(df)


def test_mode_table_ties_types_and_all_missing(spark):
    from tabsmith.operators.cleaning import mode_table, mode_values

    df = spark.createDataFrame(
        [("b", 10, None), ("a", 2, None), (None, 10, None), ("a", 2, None), ("b", 3, None)],
        "s string, i int, empty double")
    got = {r["column"]: (r["value"], r["cnt"]) for r in mode_table(df).collect()}
    # ties broken by the smallest value in the column's own order (2 < 10 as numbers)
    assert got == {"s": ("a", 2), "i": ("2", 2)}
    assert mode_values(df, ["s", "i", "empty"]) == {"s": "a", "i": 2, "empty": None}


def test_missing_count_one_column(spark):
    from tabsmith.operators.quality import missing_count

    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y"), (2.0, None)], "v double, s string")
    r = missing_count(df, "v").first()
    assert (r["column"], r["missing_count"], r["missing_pct"]) == ("v", 2, 50.0)
