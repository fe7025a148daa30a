"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests and bench. On a cluster, build the session with your own config."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tempest")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TEMPEST_DRIVER_MEMORY", "16g"))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system path set by whoever runs the job. Only a local
    master without the setting (tests, bench) gets a fresh folder under the system temp directory.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="tempest-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(conf)
    return conf.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder (stream checkpoints, sink outputs)."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system holds it (nothing happens if it is not there)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


_OWNED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("tempest_owned", default=None)


@contextlib.contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`materialize` writes inside are removed at the end: for work whose results are written
    elsewhere by then, such as a micro-batch."""
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for p in paths:
            remove_path(spark, p)


_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_VECTORED_CONF = "parquet.hadoop.vectored.io.enabled"


def ensure_plain_reads(spark: SparkSession) -> None:
    """Parquet's vectored reads of local files take whole column chunks through direct buffers, of which the JDK keeps the
    largest for every reading thread, besides the heap. Without them, unless the session says otherwise."""
    if spark.conf.get(_VECTORED_CONF, None) is None:
        spark.conf.set(_VECTORED_CONF, "false")


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    old = {c: spark.conf.get(c, None) for c in values}
    for c, v in values.items():
        spark.conf.set(c, v)
    try:
        yield
    finally:
        for c, v in old.items():
            if v is None:
                spark.conf.unset(c)
            else:
                spark.conf.set(c, v)


def materialize(df, name: str, batch_rows: int | None = None):
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back: cuts the
    lineage (a lost executor re-reads the table instead of recomputing the plan) in a single job.
    ``Dataset.checkpoint`` would compute an unpersisted plan twice (count, then write).

    The write's own shuffle files are removed when it has ended: nothing reads them again, and a job of many
    such steps would otherwise keep them all until the driver collects its garbage.

    ``batch_rows``: rows of an Arrow batch on the way to Python at most, for rows of many KB: a batch is held whole outside the
    heap, and again in the worker."""
    spark = df.sparkSession
    ensure_plain_reads(spark)
    path = scratch_path(spark, name)
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    with _settings(spark, **{_CLEANUP_CONF: "true"}, **({_BATCH_CONF: str(batch_rows)} if batch_rows else {})):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: an empty table has no files
    out.__dict__["scratch"] = path
    return out


def discard(*tables) -> None:
    """Remove the files of tables that :func:`materialize` wrote, once all that reads them is written too. Other
    DataFrames (also those made from such a table) are passed over."""
    for t in tables:
        if path := t.__dict__.get("scratch"):
            remove_path(t.sparkSession, path)
