from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        # A zone with clock changes: no result may depend on it.
        .config("spark.sql.session.timeZone", "Europe/Helsinki")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Small frame from a DDL schema and tuples; times are written as text."""

    def make(schema: str, *data: tuple):
        frame = spark.createDataFrame(list(data), schema.replace("timestamp", "string"))
        for part in schema.split(","):
            name, kind = part.split(maxsplit=1)
            if kind.strip() == "timestamp":
                frame = frame.withColumn(name, frame[name].cast("timestamp_ntz"))
        return frame

    return make
