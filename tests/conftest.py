import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rulemill-test-"))
    yield session


@pytest.fixture
def make_lines(spark):
    """Lines from {source: (priority, text)}, in registry order, small chunks."""
    from rulemill.sources.lists import list_lines

    def make(texts, chunk_lines=3):
        rows = [
            (name, priority, position, position == 0, text)
            for position, (name, (priority, text)) in enumerate(texts.items())
        ]
        snapshots = spark.createDataFrame(
            rows, "source string, priority int, source_ord int, lite boolean, text string"
        )
        return list_lines(snapshots, chunk_lines)

    return make
