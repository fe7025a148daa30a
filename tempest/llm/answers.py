"""Values for the distinct keys of blocks, sent back without the keys.

Blocks of rows (``blocks``) each have many 64-bit keys, and a value belongs to every key. A hash deals a block's sorted
distinct keys to shards: one row (shard, block, keys) each, packed as differences in byte planes and written once
(``ask``). A shard gives out its distinct keys (``distinct_keys``), for which the caller finds the values, and returns
them to each block in the order in which the block sent its keys (``answer``): 8 bytes a key. The block has its keys
already and puts the values beside them (``in_order``). Shards grow with the number of blocks, blocks are bounded and
a block sends a key once, so a task holds a bounded number of keys however frequent one of them is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tempest.llm.blocks import unpack_table
from tempest.llm.textops import mix
from tempest.session import materialize


def pack_keys(k: np.ndarray) -> bytes:
    """Sorted int64 keys as differences, first all their lowest bytes, then the next ones: the high ones are runs of zeros."""
    return np.diff(k, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(x: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.int64).ravel())


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by shard, then by key; shard of each key) of sorted keys."""
    shard = (((mix(keys.view(np.uint64)) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    return np.argsort(shard, kind="stable"), shard


def ask(blocks: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], shards: int, name: str = "asked") -> DataFrame:
    """(shard int, block long, v binary), written. ``keys_of(rows)``: the sorted distinct int64 keys of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload")):
                keys = keys_of(unpack_table(payload.as_py()))
                if not len(keys):
                    continue
                order, shard = _dealt(keys, shards)
                k, s = keys[order], shard[order]
                cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                ends = np.append(cut[1:], len(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s[cut].astype(np.int32)), pa.array(np.full(len(cut), block, np.int64)),
                     pa.array([pack_keys(k[x:y]) for x, y in zip(cut, ends)], pa.binary())], ["shard", "block", "v"])
                pa.default_memory_pool().release_unused()  # a worker lives on after the task

    return materialize(blocks.mapInArrow(run, "shard int, block long, v binary"), name)


def distinct_keys(asked: DataFrame, key: str) -> DataFrame:
    """(shard, key): every key that some block asked for, once."""

    def run(t: pa.Table) -> pa.Table:
        k = np.unique(np.concatenate([unpack_keys(x) for x in t["v"].to_pylist()]))
        return pa.table({"shard": pa.array(np.full(len(k), t["shard"][0].as_py(), np.int32)), key: pa.array(k)})

    return asked.select("shard", "v").groupBy("shard").applyInArrow(run, f"shard int, {key} long")


def answer(asked: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """(block, shard, values): for each request the values (float64, packed) of its keys. values: (shard, key, value)
    with a row for each of ``distinct_keys``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        k, v = right[key].to_numpy(), right[value].to_numpy()
        order = np.argsort(k)
        k, v = k[order], v[order].astype(np.float64)
        out = [v[np.searchsorted(k, unpack_keys(x.as_py()))].tobytes() for x in left["v"]]
        return pa.table({"block": left["block"], "shard": left["shard"], "values": pa.array(out, pa.binary())})

    return asked.groupBy("shard").cogroup(values.select("shard", key, value).groupBy("shard")).applyInArrow(
        run, "block long, shard int, values binary")


def in_order(keys: np.ndarray, answers: pa.Table, shards: int) -> np.ndarray:
    """The values of a block's sorted distinct keys, from all its answers."""
    out = np.zeros(len(keys))
    if len(keys):
        t = answers.sort_by("shard")
        out[_dealt(keys, shards)[0]] = np.concatenate([np.frombuffer(x.as_py(), np.float64) for x in t["values"]])
    return out
