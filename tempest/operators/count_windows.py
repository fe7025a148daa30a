"""Count windows per key (``countWindow(size)`` and ``countWindow(size, slide)``), batch form.

Both start from the row's position ``rn`` within its key (hot-key-safe block scan), after which every
window is a group of at most ``size`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.operators.scan import DEFAULT_BLOCK, join_null_safe, keyed_rank, keyed_running, last_rows_frame, latest_rows


def count_window_tumble(df: DataFrame, size: int = 10, key: str = "id", field: str = "temperature",
                        seq: str = "seq", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``countWindow(size).apply(avg)``: the average of each full block of ``size`` records of a key;
    an incomplete last block never fires. Output ``(id, block, avg_temp)``, block numbered from 0."""
    ranked = keyed_rank(df, [key], seq, name="_rn", block=block)
    return (
        ranked.withColumn("block", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long"))
        .groupBy(key, "block")
        .agg(F.count(F.lit(1)).alias("_n"), F.avg(field).alias("avg_temp"))
        .where(F.col("_n") == size)
        .select(key, "block", "avg_temp")
    )


def count_window_slide(df: DataFrame, size: int = 10, slide: int = 2, key: str = "id", field: str = "temperature",
                       seq: str = "seq", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``countWindow(size, slide).aggregate(avg)``: at every ``slide``-th record of a key, the average
    of its last ``size`` (or fewer) records. Output ``(id, seq, avg_temp)`` — ``seq`` of the firing record.

    The frame of a position is a row window over bounded blocks of positions (see ``last_rows_frame``).
    """
    return CountWindow(size, slide, key, field, seq).run(df, block=block)


@dataclass(frozen=True)
class CountWindow:
    """:func:`count_window_slide` as a keyed operator for streams (``folds.run_keyed``; ``slide == size``: full blocks
    only). State per key: ``n`` records so far and ``tail``, its last ``size - 1`` readings in arrival order."""

    size: int
    slide: int
    key: str = "id"
    field: str = "temperature"
    seq: str = "seq"

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,)

    def _tails(self, base: DataFrame, df: DataFrame) -> DataFrame:
        """The tails of the keys of ``df`` as rows, with their positions."""
        old = join_null_safe(base, df.select(self.key).distinct(), self.keys, "left_semi")
        old = old.select(self.key, (F.col("n") - F.size("tail")).alias("_first"), F.posexplode("tail").alias("_at", "t"))
        return old.select(self.key, F.col("t.seq").alias(self.seq), F.col("t.v").alias(self.field), (F.col("_first") + F.col("_at") + 1).alias("_rn"))

    def run(self, df: DataFrame, base: DataFrame | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
        rows = df.select(self.key, self.seq, self.field)
        before = None if base is None else base.select(self.key, F.col("n").alias("_rn"))
        rows = keyed_running(rows, self.keys, {"_rn": ("count", F.lit(1))}, self.seq, block=block, base=before).withColumn("_new", F.lit(True))
        if base is not None:
            rows = rows.unionByName(self._tails(base, df).withColumn("_new", F.lit(False)))
        out = last_rows_frame(rows, self.keys, "_rn", self.size, {"avg_temp": F.avg(self.field)})
        return out.where(F.col("_new") & (F.col("_rn") % self.slide == 0)).select(self.key, self.seq, "avg_temp")

    def totals(self, df: DataFrame, base: DataFrame | None = None) -> DataFrame:
        n = df.groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        recent = df.select(self.key, self.seq, self.field)
        if base is not None:
            n = join_null_safe(n, base.select(self.key, F.col("n").alias("_n")), self.keys, "left").select(
                self.key, (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"))
            recent = recent.unionByName(self._tails(base, df).drop("_rn"))
        recent = latest_rows(recent, self.keys, [self.seq], self.size - 1).groupBy(self.key).agg(
            F.array_sort(F.collect_list(F.struct(F.col(self.seq).alias("seq"), F.col(self.field).alias("v")))).alias("tail"))  # size - 1 at most
        none = F.expr("cast(array() as array<struct<seq:bigint,v:double>>)")
        return join_null_safe(n, recent, self.keys, "left").select(self.key, "n", F.coalesce("tail", none).alias("tail"))
