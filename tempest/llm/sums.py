"""Corpus-wide sums of 64-bit keys, answered to each block in the order in which it asked.

Rows (block long, keys binary, counts binary) hold a block's sorted distinct keys (uint64) and its count of each
(uint32). A hash of the key chooses a shard; a block sends each shard its keys and counts as packed arrays, the shard adds
them up and sends the totals back without the keys, since the block knows their order. A frequent key is one entry a
block, whatever its number of occurrences; shards grow with the number of keys asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.llm.textops import mix

#: Keys that one shard gets on average.
SHARD_KEYS = 1_000_000


def number_of_shards(total: int, keys_per_shard: int = SHARD_KEYS) -> int:
    return max(4, -(-total // keys_per_shard))


def dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, shards present, their starts and ends in that order); the order keeps a shard's keys as they come."""
    v = mix(keys)
    shard = (((v >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    s = shard[order]
    cut = np.flatnonzero(np.concatenate(([len(s) > 0], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return order, s[cut], cut, np.append(cut[1:], len(s)) if len(s) else cut


def sharded_totals(blocks: DataFrame, shards: int, summary: Callable[[np.ndarray, np.ndarray], tuple[bytes, bytes]]) -> DataFrame:
    """(block, shard, totals binary, s_keys binary, s_values binary): the totals (int64) of what ``block`` asked of
    ``shard``, in its order. One row of each shard also has ``summary(keys, totals)`` of its distinct keys."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, keys, counts in zip(b.column("block").to_pylist(), b.column("keys"), b.column("counts")):
                k, n = np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.uint32)
                order, present, cut, ends = dealt(k, shards)
                k, n = k[order], n[order]
                if len(present):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(present), pa.array(np.full(len(present), block, np.int64)),
                         pa.array([k[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary()),
                         pa.array([n[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary())], ["shard", "block", "k", "n"])

    def answer(g: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint64) for x in g["k"].to_pylist()]
        u, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, at, np.concatenate([np.frombuffer(x, np.uint32) for x in g["n"].to_pylist()]).astype(np.int64))
        ends = np.cumsum([len(k) for k in keys])
        s_keys, s_values = summary(u, total)
        none = [None] * (len(keys) - 1)
        return pa.table({"block": g["block"], "shard": g["shard"],
                         "totals": pa.array([total[at[e - len(k) : e]].tobytes() for k, e in zip(keys, ends)], pa.binary()),
                         "s_keys": pa.array([s_keys, *none], pa.binary()), "s_values": pa.array([s_values, *none], pa.binary())})

    asked = blocks.select("block", "keys", "counts").mapInArrow(ask, "shard long, block long, k binary, n binary")
    return asked.groupBy("shard").applyInArrow(answer, "block long, shard long, totals binary, s_keys binary, s_values binary")


def by_block(totals: DataFrame) -> DataFrame:
    """(block, answers): a block's answers in the order of their shards."""
    return totals.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "totals"))).alias("answers"))  # a bounded block's


def placed(keys: np.ndarray, shards: int, answers: list[dict]) -> np.ndarray:
    """The totals of a block's keys, in the order of ``keys``."""
    out = np.zeros(len(keys), np.int64)
    if len(keys):
        out[dealt(keys, shards)[0]] = np.concatenate([np.frombuffer(x["totals"], np.int64) for x in answers])
    return out
