import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from weirflow.session import local_session

    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def feed(spark):
    """Messages in the given order, as a feed."""
    from weirflow.sources.topics import TOPIC_SCHEMA

    def make(*values):
        rows = spark.createDataFrame(
            [(v, "t", 0, n) for n, v in enumerate(values)],
            "value STRING, topic STRING, partition INT, offset BIGINT",
        )
        return rows.selectExpr("*", "timestamp_millis(offset) AS timestamp").to(
            spark.createDataFrame([], TOPIC_SCHEMA).schema
        )

    return make
