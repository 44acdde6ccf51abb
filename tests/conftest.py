import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").appName("viewstar tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    from viewstar.staging import Staging
    with Staging(spark) as folder:
        yield folder


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()
    return text


@pytest.fixture
def events(spark):
    """Build event frames from short rows: time, product, store, referrer, device."""
    from viewstar.schemas import EVENT

    def build(rows):
        return spark.createDataFrame(rows, EVENT)
    return build
