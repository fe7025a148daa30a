"""Sensor readings: the record type, its text forms, and the sensor view over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempest.functions.java import java_double_text, java_split

# The reading record (id, timestamp in epoch seconds, temperature); all fields nullable.
READING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)

# The table form with the column renamed to `temp`.
TABLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temp", T.DoubleType()),
    ]
)

# Display form of a reading, `SensorReading{id='…', timestamp=…, temperature=…}`.
TEXT_PREFIX = "SensorReading{id='"
TEXT_TS = "', timestamp="
TEXT_TEMP = ", temperature="
TEXT_END = "}"


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ column (wall time read as UTC).

    Built from the date and time-of-day fields, which never pass through the session time zone (a
    cast to TIMESTAMP would, and would shift by the zone's DST offset)."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * F.lit(86400)
        + F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60) + F.second(ts)
    )


def sensor_view(events: DataFrame) -> DataFrame:
    """Readings derived from ``events``: one reading per event, ``seq`` is the arrival sequence.

    id = 'sensor_' || user_id, timestamp = whole epoch seconds of ts, temperature = value, seq = event_id.
    """
    return events.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"),
    )


def with_rowtime(df: DataFrame, ts_col: str = "timestamp", name: str = "rt") -> DataFrame:
    """Event-time attribute: epoch seconds → TIMESTAMP (an instant, so windows align to the epoch)."""
    return df.withColumn(name, F.timestamp_seconds(F.col(ts_col)))


def to_line(df: DataFrame) -> Column:
    """CSV text line ``id,timestamp,temperature`` of a reading (no header, JDK number text)."""
    return F.concat_ws(",", F.col("id"), F.col("timestamp").cast("string"), java_double_text(F.col("temperature")))


def reading_text(df: DataFrame) -> Column:
    """The display string of a reading, as its ``toString`` prints it."""
    return F.concat(
        F.lit(TEXT_PREFIX),
        F.coalesce(F.col("id"), F.lit("null")),
        F.lit(TEXT_TS),
        F.coalesce(F.col("timestamp").cast("string"), F.lit("null")),
        F.lit(TEXT_TEMP),
        F.coalesce(java_double_text(F.col("temperature")), F.lit("null")),
        F.lit(TEXT_END),
    )


def parse_lines(lines: DataFrame, value_col: str = "value", mode: str = "failfast", keep: list[str] | None = None):
    """Parse ``id,timestamp,temperature`` lines (extra fields ignored).

    mode="failfast": a missing or malformed field fails the job, as the JDK parse throws.
    mode="permissive": returns ``(good, rejects)``; rejects keep the raw line.
    """
    keep = keep or []
    f = java_split(F.col(value_col), ",")
    fields = lines.select(
        *keep,
        F.col(value_col).alias("_line"),
        F.try_element_at(f, F.lit(1)).alias("_f0"),
        F.try_element_at(f, F.lit(2)).alias("_f1"),
        F.try_element_at(f, F.lit(3)).alias("_f2"),
    )
    if mode == "failfast":
        return fields.select(
            *keep,
            _strict(F.col("_f0"), None).alias("id"),
            _strict(F.col("_f1"), "bigint").alias("timestamp"),
            _strict(F.col("_f2"), "double").alias("temperature"),
        )
    if mode != "permissive":
        raise ValueError(f"unknown mode {mode!r}")
    parsed = fields.select(
        *keep,
        "_line",
        F.col("_f0").alias("id"),
        F.when(F.col("_f1").rlike(r"^[+-]?[0-9]+$"), F.col("_f1").try_cast("bigint")).alias("timestamp"),
        F.col("_f2").try_cast("double").alias("temperature"),
    )
    ok = F.col("id").isNotNull() & F.col("timestamp").isNotNull() & F.col("temperature").isNotNull()
    good = parsed.where(ok).drop("_line")
    rejects = parsed.where(~ok).select(*keep, F.col("_line").alias(value_col))
    return good, rejects


def _strict(c: Column, to: str | None) -> Column:
    """Field access/cast that raises on a missing or malformed field, whatever the ANSI setting."""
    if to is None:
        return F.when(c.isNull(), F.raise_error(F.lit("missing field in reading line"))).otherwise(c)
    # the JDK's long parse takes no blanks around the digits (its double parse does)
    cast = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast(to)) if to == "bigint" else c.try_cast(to)
    return F.when(
        cast.isNull(), F.raise_error(F.concat(F.lit("malformed or missing field in reading line: "), F.coalesce(c, F.lit("<none>"))))
    ).otherwise(cast)
