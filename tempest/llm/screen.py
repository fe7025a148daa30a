"""Which keys occur more than once in the whole corpus, answered with a bit a key.

Blocks of rows (``blocks``) each have many 64-bit keys. A key's high bits choose a shard; a block sends each shard
the other 32 bits of its keys as one packed, sorted array (with an 8-byte tag a key if *distinct tags* are asked for).
The shard finds the values that it got twice or more and returns one bit a key, which the block unpacks in the order
it sent. Two keys may share their shard and 32 bits, so "more than once" is a superset: a filter for exact work.
Shards grow with the number of keys and blocks are bounded, so no task holds more than a bounded amount unless one
key is more frequent than that; then it is still 4 (12) bytes an occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.llm.blocks import unpack_table
from tempest.llm.textops import mix

#: Keys that one shard gets on average.
SHARD_KEYS = 2_000_000

#: rows → (keys, their tags or None, where the keys belong: handed on to ``Apply``)
Items = Callable[[pa.RecordBatch], tuple[np.ndarray, "np.ndarray | None", np.ndarray]]
Apply = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, shard, 32-bit value) of keys, ordered by shard and value."""
    v = mix(keys)
    shard = (((v >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    low = (v & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    order = np.lexsort((low, shard))
    return order, shard, low


def _twice(values: np.ndarray, tags: np.ndarray | None) -> np.ndarray:
    """The sorted values that occur twice or more (with two distinct tags or more)."""
    if tags is None:
        u, n = np.unique(values, return_counts=True)
        return u[n > 1]
    order = np.lexsort((tags, values))
    v, t = values[order], tags[order]
    return np.unique(v[1:][(v[1:] == v[:-1]) & (t[1:] != t[:-1])])


def screened(blocks: DataFrame, items: Items, apply: Apply, schema: str, total: int, tagged: bool = False) -> DataFrame:
    """``apply(rows, keys, place, more)`` for every block (block long, payload binary): ``keys`` and ``place`` as
    ``items(rows)`` gives them, ``more[i]``: key i occurs elsewhere in the corpus too (or again in this block).
    ``total``: number of keys."""
    shards = max(4, -(-total // SHARD_KEYS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload")):
                keys, tags, _ = items(unpack_table(payload.as_py()))
                if not len(keys):
                    continue
                order, shard, low = _dealt(keys, shards)
                s, v = shard[order], low[order]
                t = tags[order] if tagged else None
                cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                ends = np.append(cut[1:], len(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s[cut]), pa.array(np.full(len(cut), block, np.int64)),
                     pa.array([v[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary()),
                     pa.array([t[x:y].tobytes() if tagged else b"" for x, y in zip(cut, ends)], pa.binary())], ["shard", "block", "v", "t"])

    def answer(g: pa.Table) -> pa.Table:
        values = [np.frombuffer(x, np.uint32) for x in g["v"].to_pylist()]
        tags = np.concatenate([np.frombuffer(x, np.int64) for x in g["t"].to_pylist()]) if tagged else None
        u = _twice(np.concatenate(values), tags)
        bits = []
        for v in values:
            at = np.minimum(np.searchsorted(u, v), max(len(u) - 1, 0))
            bits.append(np.packbits(u[at] == v if len(u) else np.zeros(len(v), bool)).tobytes())
        return pa.table({"block": g["block"], "shard": g["shard"], "bits": pa.array(bits, pa.binary())})

    asked = blocks.mapInArrow(ask, "shard long, block long, v binary, t binary")
    bits = (asked.groupBy("shard").applyInArrow(answer, "block long, shard long, bits binary")
            .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "bits"))).alias("answers")))  # a bounded block's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload, answers in zip(b.column("payload"), b.column("answers")):
                rows = unpack_table(payload.as_py())
                keys, _, place = items(rows)
                more = np.zeros(len(keys), bool)
                if len(keys):
                    order, shard, _ = _dealt(keys, shards)
                    sizes = np.bincount(shard, minlength=shards)
                    got = [np.unpackbits(np.frombuffer(x["bits"], np.uint8))[: sizes[x["shard"]]] for x in answers.as_py()]
                    more[order] = np.concatenate(got).astype(bool)
                yield apply(rows, keys, place, more)

    return blocks.join(bits, "block").select("payload", "answers").mapInArrow(run, schema)
