"""Rolling (per record) keyed aggregations: one output row per input row, in arrival order.

Each is a running aggregate per key in ``seq`` order, computed with the hot-key-safe block scan
(``tempest.operators.scan``) instead of a per-key window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.operators.scan import DEFAULT_BLOCK, Running, keyed_running


def rolling_sum(df: DataFrame, key: str = "id", field: str = "temperature", seq: str = "seq",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """``keyBy(key).sum(field)``: per record, the first record of the key with ``field`` replaced by
    the running sum (the other fields stay those of the key's first record)."""
    others = [c for c in df.columns if c not in (key, field, seq)]
    firsts = {f"_first_{c}": ("first", F.col(c)) for c in others}
    out = keyed_running(df, [key], {"_sum": ("sum", F.col(field)), **firsts}, seq, block=block)
    return out.select(seq, key, *[F.col(f"_first_{c}").alias(c) for c in others], F.col("_sum").alias(field))


def rolling_max(df: DataFrame, key: str = "id", field: str = "temperature", seq: str = "seq",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """``keyBy(key).max(field)``: running maximum of ``field``; other fields from the key's first record."""
    others = [c for c in df.columns if c not in (key, field, seq)]
    firsts = {f"_first_{c}": ("first", F.col(c)) for c in others}
    out = keyed_running(df, [key], {"_max": ("max", F.col(field)), **firsts}, seq, block=block)
    return out.select(seq, key, *[F.col(f"_first_{c}").alias(c) for c in others], F.col("_max").alias(field))


def max_by_spec(others: Sequence[str], key: str = "id", field: str = "temperature", seq: str = "seq") -> Running:
    """Running arg-max: nulls below every number, the earliest record on ties."""
    best = F.struct(F.col(field).alias("_v"), (-F.col(seq)).alias("_ns"), *[F.col(c) for c in others])
    return Running((key,), {"_best": ("max", best)}, lambda d: d.select(
        seq, key, (-F.col("_best._ns")).alias("max_seq"), *[F.col("_best")[c].alias(c) for c in others],
        F.col("_best._v").alias(field)), seq=seq)


def rolling_max_by(df: DataFrame, key: str = "id", field: str = "temperature", seq: str = "seq",
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """``keyBy(key).maxBy(field)``: per record, the whole record holding the running maximum; on ties
    the earliest record wins (``max_by`` would not guarantee that). Adds ``max_seq``."""
    return max_by_spec([c for c in df.columns if c not in (key, field, seq)], key, field, seq).run(df, block=block)


def reduce_max_spec(key: str = "id", field: str = "temperature", ts: str = "timestamp", seq: str = "seq") -> Running:
    return Running((key,), {"_max": ("max", F.col(field))}, lambda d: d.select(seq, key, ts, F.col("_max").alias(field)), seq=seq)


def rolling_reduce_max(df: DataFrame, key: str = "id", field: str = "temperature", ts: str = "timestamp",
                       seq: str = "seq", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``reduce((prev, cur) -> (id, cur.timestamp, max(prev.temp, cur.temp)))`` per key."""
    return reduce_max_spec(key, field, ts, seq).run(df, block=block)


def count_spec(key: str = "id", seq: str = "seq", name: str = "cnt") -> Running:
    return Running((key,), {name: ("count", F.lit(1))}, lambda d: d.select(seq, key, name), seq=seq)


def keyed_count(df: DataFrame, key: str = "id", seq: str = "seq", name: str = "cnt",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Keyed value-state counter: per record, how many records of its key arrived so far."""
    return count_spec(key, seq, name).run(df, block=block)


def shard_count(df: DataFrame, shard: str = "shard", seq: str = "seq", name: str = "cnt",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Operator-state counter, re-aimed: a running count per explicit shard column (the reference
    counts per parallel subtask, which has no meaning across a re-partitioned Spark job)."""
    return count_spec(shard, seq, name).run(df, block=block)
