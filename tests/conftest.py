import tempfile

import pytest
from pyspark.sql import SparkSession

from tidematch.session import ROCKSDB_PROVIDER


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tidematch-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(f"{folder}/checkpoints")
    yield session
    session.stop()
