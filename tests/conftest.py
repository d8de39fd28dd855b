import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clipledger.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clipledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def documents(spark):
    """A DataFrame of numbered JSON documents: n, item, client, fetched_at."""
    from pyspark.sql import functions as F

    def make(*texts):
        rows = [(n, text) for n, text in enumerate(texts)]
        return spark.createDataFrame(rows, "n int, text string").select(
            "n",
            F.parse_json("text").alias("item"),
            F.lit("u1").alias("client"),
            F.lit("v1").alias("video_id"),
            F.timestamp_seconds(F.lit(86400)).alias("fetched_at"),
        )

    return make
