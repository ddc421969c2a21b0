import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("tabsmith-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def sample_csv(tmp_path):
    """Coffee lots: a blank after each comma, one missing roast, the first lot listed twice."""
    path = tmp_path / "lots.csv"
    path.write_text("lot, roast, grade\n7, dark, B\n7, dark, B\n12, NA, A\n15, dark, A\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def crates(spark):
    """Fruit crates with one unknown farm, one unknown fruit and a padded state."""
    return spark.createDataFrame(
        [(1, 10.0, "apple", "north", "ripe"), (2, 12.5, "pear", None, "green"), (3, 9.0, None, "north", "green"),
         (4, 11.0, "plum", "south", "ripe"), (5, 10.0, "pear", "north", " ripe")],
        "crate long, kilos double, fruit string, farm string, state string")
