"""Text and CSV file sources, batch and streaming.

A live socket line stream (a single-machine test source) is re-aimed as a landing directory read with
``readStream.text``: fault tolerant and replayable, which a socket is not. Files are picked up in
modification-time order, so writers must create them in arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempest.operators.scan import BLK
from tempest.readings import READING_SCHEMA, TABLE_SCHEMA
from tempest.session import materialize


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bounded text file(s) → one row per line, column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded line stream over a directory (column ``value``)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def read_readings_csv(spark: SparkSession, path: str, mode: str = "FAILFAST", table_names: bool = False) -> DataFrame:
    """CSV readings with the declared schema (no inference); ``table_names`` gives ``temp``."""
    return spark.read.schema(TABLE_SCHEMA if table_names else READING_SCHEMA).option("mode", mode).csv(path)


def stream_readings_csv(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        table_names: bool = False) -> DataFrame:
    r = spark.readStream.schema(TABLE_SCHEMA if table_names else READING_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


# ---------------------------------------------------------------- lines with arrival numbers

_PLACE = {"file": "_metadata.file_path", "at": "_metadata.file_block_start", "landed": "_metadata.file_modification_time"}


def _located(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("value").alias("line"), *[F.col(c).alias(n) for n, c in _PLACE.items()])


def read_lines_located(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the split they were read from: ``(line, file, at, landed)`` (path, first byte, modification time)."""
    return _located(read_lines(spark, path))


def stream_lines_located(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same on a landing folder, for ``folds.run_lines``."""
    return _located(stream_lines(spark, path, max_files_per_trigger))


def number_lines(located: DataFrame, by_time: bool = True) -> DataFrame:
    """``(arrival, file, line_no, line)`` from 0: files in landing order (modification time, then path; or by path alone),
    lines in file order. Lines keep the place where they were read: nothing is sorted.

    A task reads a split of a file from front to back, so ``monotonically_increasing_id`` orders the lines of a split; the
    table is written once, for one numbering. A line's number is its place in the split plus the lines of the splits and
    files before, a prefix over one summary row per split (in its file), and over one row per file (in runs of files).
    A split's rows then meet its summary row in a join that Spark may broadcast."""
    d = materialize(located.withColumn("_mid", F.monotonically_increasing_id()), "lines")
    splits = d.groupBy("file", "at").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"), F.min("landed").alias("_landed"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_in_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    order = ["_landed", "file"] if by_time else ["file"]
    files = d.groupBy("file").agg(F.min("landed").alias("_landed"), F.count(F.lit(1)).alias("_n"))
    # files in runs of one range partition each; the prefix over the runs is one row per run
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = materialize(files.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "files")
    files = files.withColumn(BLK, F.shiftright("_id", 33))
    runs = files.groupBy(BLK).agg(F.sum("_n").alias("_r"))
    before_run = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    runs = runs.select(BLK, F.coalesce(F.sum("_r").over(before_run), F.lit(0)).alias("_before_run"))
    in_run = Window.partitionBy(BLK).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_in_run", F.coalesce(F.sum("_n").over(in_run), F.lit(0))).join(runs, BLK)
    places = splits.join(files.select("file", (F.col("_before_run") + F.col("_in_run")).alias("_before")), "file")
    out = d.join(places.select("file", "at", "_first", "_in_file", "_before"), ["file", "at"])
    line_no = F.col("_mid") - F.col("_first") + F.col("_in_file")
    return out.select((F.col("_before") + line_no).alias("arrival"), "file", line_no.alias("line_no"), "line")


def lines_with_arrival(spark: SparkSession, path: str, by_time: bool = True) -> DataFrame:
    """Text file(s) with a stable arrival number per line: ``(arrival, file, line_no, line)`` (see :func:`number_lines`)."""
    return number_lines(read_lines_located(spark, path), by_time)
