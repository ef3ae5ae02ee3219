import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("spotframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cells(spark):
    """Counts table from (sample, spot, gene, value) rows."""

    def make(rows):
        return spark.createDataFrame(rows, "sample_id string, obs_id long, var_id long, x double")

    return make


@pytest.fixture
def spots(spark):
    """Spot table from (sample, spot, x, y) rows, all in tissue."""

    def make(rows):
        full = [(s, i, True, float(x), float(y)) for s, i, x, y in rows]
        return spark.createDataFrame(full, "sample_id string, obs_id long, in_tissue boolean, px double, py double")

    return make


@pytest.fixture
def genes(spark):
    """Gene table from names, ids from 0."""

    def make(names):
        return spark.createDataFrame(list(enumerate(names)), "var_id long, gene string")

    return make
