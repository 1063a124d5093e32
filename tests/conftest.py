import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from netrollup.schema import RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def raw_of(spark):
    """Raw records from (topic, message) pairs; a message may be a dict or text."""
    def make(pairs):
        lines = [
            (topic, m if m is None or isinstance(m, str) else json.dumps(m), None)
            for topic, m in pairs
        ]
        return spark.createDataFrame(lines, RAW_SCHEMA)

    return make


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
