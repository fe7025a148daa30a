"""Kafka sinks: display strings of readings, and CSV rows of a table.

Writing needs the ``spark-sql-kafka`` connector on the classpath; the payload builders are plain
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.readings import reading_text


def reading_values(df: DataFrame) -> DataFrame:
    """Readings → ``value`` = ``SensorReading{...}`` text (the string producer's payload)."""
    return df.select(reading_text(df).alias("value"))


def csv_values(df: DataFrame) -> DataFrame:
    """Table rows → ``value`` = one CSV line per row (the Kafka CSV table sink)."""
    return df.select(F.to_csv(F.struct(*df.columns)).alias("value"))


def write_kafka(values: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None):
    """Write a ``value`` column to a topic; a stream needs a checkpoint folder."""
    if values.isStreaming:
        return (values.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    values.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()
    return None
