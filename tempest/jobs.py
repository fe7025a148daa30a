"""Whole jobs composed from the library: the Kafka CSV table job and a restartable stream run.

The transformation parts are pure ``DataFrame → DataFrame`` functions, so they run (and are tested)
on files as well as on Kafka topics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempest.operators.tables import select_where
from tempest.sinks.kafka import csv_values
from tempest.sources.kafka import csv_values as parse_csv_values


def kafka_table_transform(values: DataFrame, sensor: str = "sensor_1") -> DataFrame:
    """CSV payloads in → ``select id, temp where id = sensor`` → CSV payloads out."""
    rows = parse_csv_values(values)
    return csv_values(select_where(rows, sensor, cols=("id", "temp")))


def kafka_table_job(spark: SparkSession, bootstrap_servers: str, source_topic: str, sink_topic: str,
                    checkpoint: str, sensor: str = "sensor_1"):
    """Kafka CSV topic → filter → Kafka CSV topic (needs the Kafka connector on the classpath)."""
    from tempest.sinks.kafka import write_kafka
    from tempest.sources.kafka import read_kafka

    return write_kafka(kafka_table_transform(read_kafka(spark, bootstrap_servers, source_topic), sensor),
                       bootstrap_servers, sink_topic, checkpoint)
