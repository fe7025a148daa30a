"""Table API / SQL surface: views, projection + filter, grouped count/average, CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.sources.files import read_readings_csv, stream_readings_csv


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``createTemporaryView(name, table)``; works for batch and streaming DataFrames."""
    df.createOrReplaceTempView(name)
    return df


def table_view(df: DataFrame, renames: dict[str, str] | None = None, rowtime: str | None = None,
               ts_col: str = "timestamp", watermark: str | None = None) -> DataFrame:
    """A table form of a stream or batch: renamed columns, and an optional event-time column ``rowtime`` (TIMESTAMP from epoch seconds) with an optional watermark delay."""
    out = df
    if rowtime:
        out = out.withColumn(rowtime, F.timestamp_seconds(F.col(ts_col)))
    for old, new in (renames or {}).items():
        out = out.withColumnRenamed(old, new)
    if rowtime and watermark:
        out = out.withWatermark(rowtime, watermark)
    return out


def select_where(df: DataFrame, value: str = "sensor_1", cols: tuple[str, ...] = ("id", "temperature"),
                 key: str = "id") -> DataFrame:
    """Projection and an equality filter on the key (pushed down to the scan)."""
    return df.select(*cols).where(F.col(key) == F.lit(value))


def select_where_sql(spark: SparkSession, view: str, value: str = "sensor_1",
                     cols: tuple[str, ...] = ("id", "temperature")) -> DataFrame:
    """The same query in SQL, with a bound parameter."""
    return spark.sql(f"SELECT {', '.join(cols)} FROM {view} WHERE id = :value", args={"value": value})


def group_count_avg(df: DataFrame, key: str = "id", field: str = "temp") -> DataFrame:
    """Count and average per key (partial + final aggregate)."""
    return df.groupBy(key).agg(F.count(key).alias("cnt"), F.avg(field).alias("avg_temp"))


def group_count_avg_sql(spark: SparkSession, view: str) -> DataFrame:
    """The same aggregate as SQL text over a registered view."""
    return spark.sql(f"SELECT id, count(id) AS cnt, avg(temp) AS avg_temp FROM {view} GROUP BY id")


def read_csv_table(spark: SparkSession, path: str, name: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """A CSV file or folder as a table with the declared schema, and a view of that name if one is given."""
    df = read_readings_csv(spark, path, mode, table_names=True)
    if name:
        df.createOrReplaceTempView(name)
    return df


def stream_csv_table(spark: SparkSession, path: str, name: str | None = None, max_files: int | None = None) -> DataFrame:
    """Streaming form of :func:`read_csv_table` over a landing directory."""
    df = stream_readings_csv(spark, path, max_files, table_names=True)
    if name:
        df.createOrReplaceTempView(name)
    return df
