import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobloom.session import apply_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a function of a string column, one per input."""

    def run(function, values):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
        return [r["v"] for r in rows.select("i", function(F.col("s")).alias("v")).orderBy("i").collect()]

    return run
