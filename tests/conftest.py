import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
        "spark.local.dir": scratch, "spark.checkpoint.dir": f"file://{scratch}/shared", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
