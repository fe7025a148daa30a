"""Retract stream of a grouped query (``toRetractStream``), batch form.

Read in arrival order, each input row that changes a key's result emits ``(false, old result)`` then
``(true, new result)``; the first row of a key emits only ``(true, new result)``. The grouped query is given by
its accumulator (running sums, counts, maxima or minima) and its result as an expression over it, so any
aggregate with such an accumulator has a changelog; the running values come from one hot-key-safe block scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempest.operators.scan import DEFAULT_BLOCK, Running


def changelog_spec(accumulators: Mapping[str, tuple[str, Column]], results: Mapping[str, Column], key: str = "id",
                   seq: str = "seq") -> Running:
    """``accumulators``: name → (``sum``/``count``/``max``/``min``, per-record column); ``results``: name →
    expression over the accumulator names. Output ``(flag, seq, key, *results)``."""
    aggs = {n: (k, c) for n, (k, c) in accumulators.items()} | {"_seen": ("count", F.lit(1))}

    def add(kind: str, old: Column, cur: Column) -> Column:
        if kind == "count":
            return F.coalesce(old, F.lit(0).cast("long")) + F.when(cur.isNotNull(), 1).otherwise(0)
        if kind == "sum":
            return F.coalesce(old + cur, old, cur)
        return F.greatest(old, cur) if kind == "max" else F.least(old, cur)

    def project(d: DataFrame) -> DataFrame:
        old = F.struct(F.lit(False).alias("flag"), *[F.col(n).alias(n) for n in accumulators])
        new = F.struct(F.lit(True).alias("flag"), *[add(k, F.col(n), c).alias(n) for n, (k, c) in accumulators.items()])
        rows = F.when(F.coalesce(F.col("_seen"), F.lit(0)) > 0, F.array(old, new)).otherwise(F.array(new))
        acc = d.select(F.col(seq), F.col(key), F.explode(rows).alias("_r")).select(seq, key, "_r.*")
        return acc.select("flag", seq, key, *[c.alias(n) for n, c in results.items()])

    return Running((key,), aggs, project, inclusive=False, seq=seq)


def count_avg_spec(key: str = "id", field: str = "temperature", seq: str = "seq") -> Running:
    """``groupBy(id).select(id, id.count, temp.avg)``: the count is of the key, the average of the readings."""
    return changelog_spec(
        {"_n": ("count", F.col(key)), "_s": ("sum", F.col(field)), "_m": ("count", F.col(field))},
        {"cnt": F.col("_n").cast("long"), "sum_temp": F.col("_s"), "avg_temp": F.try_divide(F.col("_s"), F.col("_m"))}, key, seq)


def avg_temp_spec(key: str = "id", field: str = "temperature", seq: str = "seq") -> Running:
    """The changelog of the user aggregate ``avgTemp`` (accumulator sum and count)."""
    return changelog_spec({"_s": ("sum", F.col(field)), "_m": ("count", F.col(field))},
                          {"avg_temp": F.try_divide(F.col("_s"), F.col("_m"))}, key, seq)


def retract_count_avg(df: DataFrame, key: str = "id", field: str = "temperature", seq: str = "seq",
                      block: int = DEFAULT_BLOCK) -> DataFrame:
    """Changelog rows ``(flag, seq, id, cnt, sum_temp, avg_temp)`` of the per-key count/average."""
    return count_avg_spec(key, field, seq).run(df, block=block)


def as_retract_stream(df: DataFrame, flag: str = "flag") -> DataFrame:
    """The retract form of an append-only (insert-only) result: every row is an insertion, ``(true, row)``.
    Works on batch and streaming DataFrames."""
    return df.select(F.lit(True).alias(flag), *df.columns)
