from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# FIXTURES.md §2: (seq, id, timestamp, temperature); arrival order = seq.
SENSOR_ROWS = [
    (0, "sensor_1", 1547718199, 35.8),
    (1, "sensor_6", 1547718201, 15.4),
    (2, "sensor_7", 1547718202, 6.7),
    (3, "sensor_10", 1547718205, 38.1),
    (4, "sensor_1", 1547718207, 36.3),
    (5, "sensor_1", 1547718209, 32.8),
    (6, "sensor_1", 1547718212, 37.1),
    (7, "sensor_1", 1547718213, 30.0),
    (8, "sensor_6", 1547718215, 15.4),
    (9, "sensor_1", 1547718204, 29.0),
    (10, "sensor_7", 1547718290, -3.0),
    (11, "sensor_1", 1547718206, 10.0),
    (12, "sensor_10", 1547718291, 48.1),
]

# FIXTURES.md §3 (rise alarm, interval 10 s)
RISE_ROWS = [
    (0, "sensor_1", 0, 10.0),
    (1, "sensor_1", 4, 11.0),
    (2, "sensor_1", 8, 11.0),
    (3, "sensor_1", 12, 12.0),
    (4, "sensor_1", 15, 9.0),
    (5, "sensor_1", 16, 9.5),
    (6, "sensor_1", 26, 9.0),
    (7, "sensor_2", 1, -5.0),
    (8, "sensor_2", 2, -4.0),
    (9, "sensor_2", 30, -3.0),
    (10, "sensor_1", 27, 20.0),
    (11, "sensor_2", 38, 1.0),
]

SCHEMA = "seq long, id string, timestamp long, temperature double"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tempest-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tempest-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sensor_df(spark):
    return spark.createDataFrame(SENSOR_ROWS, SCHEMA)


@pytest.fixture(scope="session")
def rise_df(spark):
    return spark.createDataFrame(RISE_ROWS, SCHEMA)


def rel(ts: int) -> int:
    """FIXTURES.md writes times as the digits after 1547718."""
    return ts - 1547718000
