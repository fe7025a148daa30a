"""Kafka sources: a string payload topic and a CSV-readings topic.

Reading needs the ``spark-sql-kafka`` connector on the classpath (not shipped with PySpark); the
payload decoding is a plain DataFrame function and is tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.readings import TABLE_SCHEMA


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
               group_id: str | None = None, stream: bool = True) -> DataFrame:
    """Topic as a (streaming) DataFrame with the payload as string column ``value``."""
    r = (spark.readStream if stream else spark.read).format("kafka")
    r = r.option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
    r = r.option("startingOffsets", starting_offsets)
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return decode_value(r.load())


def decode_value(raw: DataFrame) -> DataFrame:
    """Kafka record → ``value`` as UTF-8 string (``SimpleStringSchema``)."""
    return raw.select(F.col("value").cast("string").alias("value"))


def csv_values(values: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV payloads ``id,timestamp,temp`` → table rows (the Kafka CSV table source)."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLE_SCHEMA.fields)
    return values.select(F.from_csv(F.col(value_col), ddl).alias("r")).select("r.*")


def read_kafka_csv_table(spark: SparkSession, bootstrap_servers: str, topic: str, name: str | None = None, **kw) -> DataFrame:
    df = csv_values(read_kafka(spark, bootstrap_servers, topic, **kw))
    if name:
        df.createOrReplaceTempView(name)
    return df
