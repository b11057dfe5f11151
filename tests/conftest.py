import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("feedworks-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set Spark options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            name = "spark." + name.replace("_", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.fixture
def small_splits(settings):
    """Input splits of a few hundred bytes, so that small files are split too."""
    def put(size):
        settings(sql_files_maxPartitionBytes=size, sql_files_openCostInBytes=1)
    return put
