"""Streaming plumbing: stream a driver table, run a query to completion, restartable runs.

``run_to_table`` runs a streaming DataFrame with ``trigger(availableNow=True)`` into a parquet sink
below the shared checkpoint folder and returns the sink read back as a batch DataFrame. The file sink
plus its checkpoint make the run exactly-once: a run that dies is restarted with the same
``checkpointLocation`` and continues from the last committed micro-batch (P12).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tempest.readings import sensor_view
from tempest.session import scratch_path
from tempest.streaming.processors import NULL_KEY


#: Bytes of files that one micro-batch of a table stream takes at most (one file at least).
BATCH_BYTES = 256 << 20


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """Stream one driver table (``<sf_dir>/<name>.parquet``, a file or a folder of part files) as a file source.
    The glob in the path is needed for a single file: a file stream reads folders or patterns."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    r = r.option("maxFilesPerTrigger", max_files) if max_files else r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def stream_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_view(stream_table(spark, sf_dir, "events"))


@dataclass
class StreamRun:
    output: str
    checkpoint: str


_PARTITIONS_CONF = "spark.sql.shuffle.partitions"
_NO_DATA_CONF = "spark.sql.streaming.noDataMicroBatches.enabled"


def start_with_state_partitions(writer, spark: SparkSession, state_partitions: int | None = None, bounded: bool = False):
    """Start a streaming query with ``state_partitions`` shuffle (and state-store) partitions — by
    default the cluster's parallelism — leaving the session's own setting untouched: the query clones
    the session conf at start, and a restart takes the count from its checkpoint. A ``bounded`` run has no batches without
    data: a processing-time state always asks for another one, and the run would never end."""
    old = {c: spark.conf.get(c) for c in (_PARTITIONS_CONF, _NO_DATA_CONF)}
    spark.conf.set(_PARTITIONS_CONF, str(state_partitions or spark.sparkContext.defaultParallelism))
    if bounded:
        spark.conf.set(_NO_DATA_CONF, "false")
    try:
        return writer.start()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def start_to_files(stream: DataFrame, output: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True,
                   state_partitions: int | None = None):
    w = stream.writeStream.format(fmt).option("path", output).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return start_with_state_partitions(w, stream.sparkSession, state_partitions, available_now)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, run: StreamRun | None = None) -> DataFrame:
    """Run ``stream`` over everything available, then return its output as a batch DataFrame."""
    run = run or StreamRun(scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt"))
    q = start_to_files(stream, run.output, run.checkpoint)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(run.output)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def ensure_rocksdb_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store; set it when the session uses another one."""
    if spark.conf.get(_PROVIDER_CONF, None) != ROCKSDB_PROVIDER:
        spark.conf.set(_PROVIDER_CONF, ROCKSDB_PROVIDER)


def keyed(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, time_mode: str = "None") -> DataFrame:
    """``stream`` grouped by the string column ``key`` through ``processor``. A null key travels as ``NULL_KEY`` (the
    state store keeps no state for a null key) and is null again in the output."""
    ensure_rocksdb_state(stream.sparkSession)
    named = stream.withColumn(key, F.coalesce(F.col(key), F.lit(NULL_KEY)))
    out = named.groupBy(key).transformWithStateInPandas(processor, schema, "append", time_mode)
    return out.withColumn(key, F.when(F.col(key) != NULL_KEY, F.col(key))) if key in out.columns else out


def with_event_time(stream: DataFrame, ts: str = "timestamp", name: str = "rt", delay: str = "0 seconds") -> DataFrame:
    return stream.withColumn(name, F.timestamp_seconds(F.col(ts))).withWatermark(name, delay)
