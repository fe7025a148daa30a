"""In-memory sources: a collection of readings and a list of scalars (small, driver-side by nature)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempest.readings import READING_SCHEMA


def from_collection(spark: SparkSession, readings: Iterable[tuple]) -> DataFrame:
    """``fromCollection(List<SensorReading>)``: rows ``(id, timestamp, temperature)``."""
    return spark.createDataFrame(list(readings), READING_SCHEMA)


def from_elements(spark: SparkSession, *values: int) -> DataFrame:
    """``fromElements(1, 2, 4, 67, 189)``: one INT column ``value``."""
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("value", T.IntegerType())]))
