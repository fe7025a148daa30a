"""Documents in written blocks of bounded size.

Some operators need the same slice of documents twice: first to send its distinct keys (shingles, n-grams)
through a shuffle, then to apply the answers. ``write_blocks`` packs documents, in the order in which a task
reads them, into rows (block, payload): an Arrow table of about ``BLOCK_BYTES`` of text, compressed. The blocks
are a written table below the checkpoint folder, so both passes see the same ones even if executors are lost.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.llm.textops import text_steps
from tempest.session import materialize, remove_path, scratch_path

BLOCK_BYTES = 4 << 20
#: A block is written and shuffled once each, so a fifth less of disk is worth more than the time to compress.
LEVEL = 6
#: Spark's own limit (``spark.sql.sources.bucketing.maxBuckets``); beyond 2 MAX_BUCKETS blocks a bucket has more blocks.
MAX_BUCKETS = 100_000


def pack_table(t: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))) as w:
        w.write_batch(t)
    return sink.getvalue().to_pybytes()


def unpack_table(payload: bytes) -> pa.RecordBatch:
    t = pa.ipc.open_stream(payload).read_all().combine_chunks()
    return t.to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], schema=t.schema)


def pack_blocks(rows: DataFrame, binary: str, block_bytes: int = BLOCK_BYTES, name: str = "blocks", batch_rows: int | None = None) -> DataFrame:
    """As :func:`write_blocks` for rows whose bulk is the binary column ``binary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for rb in batches:
            step = max(1, rb.num_rows * block_bytes // max(1, rb.column(binary).nbytes))
            for a in range(0, rb.num_rows, step):
                held.append(rb.slice(a, step))
                size += held[-1].column(binary).nbytes
                if size >= block_bytes // 2:
                    yield _row(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield _row(block, held)

    return materialize(rows.mapInArrow(run, "block long, payload binary"), name, batch_rows)


def write_blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, name: str = "blocks", batch_rows: int | None = None) -> DataFrame:
    """(block long, payload binary) of all rows of ``docs``, written once. Slices of the reader's batches that
    are under half a block are merged, so the number of blocks follows the text and not the batches (of ``batch_rows`` at most)."""

    return materialize(docs.mapInArrow(_blocks_of(text, block_bytes), "block long, payload binary"), name, batch_rows)


@contextlib.contextmanager
def bucketed_blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, name: str = "blocks") -> Iterator[DataFrame]:
    """As :func:`write_blocks`, as a table bucketed by ``block``: what is grouped or joined with it by block is shuffled to
    it, and the blocks, which are most of the bytes, stay in their files. The table has a name in the session's catalog
    for as long as the context is open (results must be written inside); its files, below the checkpoint folder, go with it."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    table = f"tempest_{name}_{uuid.uuid4().hex[:12]}"
    rows = docs.mapInArrow(_blocks_of(text, block_bytes), "block long, payload binary")
    buckets = min(max(8, size // (2 * block_bytes)), MAX_BUCKETS)
    path = scratch_path(spark, name)
    rows.write.bucketBy(buckets, "block").option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
        remove_path(spark, path)


def _blocks_of(text: str, block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for rb, buf, _ in text_steps(batches, text, block_bytes):
            held.append(rb)
            size += len(buf)
            if size >= block_bytes // 2:
                yield _row(block, held)
                block, held, size = block + 1, [], 0
                pa.default_memory_pool().release_unused()  # a worker lives on after the task
        if held:
            yield _row(block, held)

    return run


def _row(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pack_table(t)], pa.binary())],
                                      ["block", "payload"])


def _planes(k: np.ndarray) -> np.ndarray:
    return k.view(np.uint8).reshape(len(k), -1).T


def pack_answers(rows: DataFrame, key: str, value: str, key_type: type, value_type: type, flush_rows: int = 200_000,
                 planes: bool = False) -> DataFrame:
    """(block, key, value) rows → a few rows per block with packed arrays: half the bytes in the shuffle to the blocks.
    With ``planes`` the keys of a row are ordered and stored as all their first bytes, then all their second ones, ...:
    of keys with few bytes in use the others are runs that the shuffle's compression takes away."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        block, k, v = (t[c].to_numpy() for c in ("block", key, value))
        order = np.lexsort((k, block)) if planes else np.argsort(block, kind="stable")
        block, k, v = block[order], k[order].astype(key_type), v[order].astype(value_type)
        cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        ends = np.append(cut[1:], len(block))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cut]), pa.array([(_planes(k[a:b]) if planes else k[a:b]).tobytes() for a, b in zip(cut, ends)], pa.binary()),
             pa.array([v[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())], ["block", key, value])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for rb in batches:
            if rb.num_rows:
                held.append(rb)
                n += rb.num_rows
            if n >= flush_rows:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return rows.select("block", key, value).mapInArrow(run, f"block long, {key} binary, {value} binary")


def unpack_answers(t: pa.Table, key: str, value: str, key_type: type, value_type: type, planes: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The (keys, values) of one block, ordered by key."""
    width = np.dtype(key_type).itemsize
    parts = [np.frombuffer(x, np.uint8).reshape(width, -1).T.tobytes() if planes else x for x in t[key].to_pylist()]
    k = np.concatenate([np.zeros(0, key_type), *[np.frombuffer(x, key_type) for x in parts]])
    v = np.concatenate([np.zeros(0, value_type), *[np.frombuffer(x, value_type) for x in t[value].to_pylist()]])
    order = np.argsort(k, kind="stable")
    return k[order], v[order]
