from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def build_session(cores: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postgrain-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()
