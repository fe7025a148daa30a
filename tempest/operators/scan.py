"""Running (prefix) aggregates per key in arrival order, safe for hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one task; if one sensor
holds a third of all readings, one task does a third of the job. Instead the arrival sequence is cut
into blocks of ``block`` consecutive ``seq`` values, and:

1. a window over (key, block) — at most ``block`` rows, because ``seq`` is a unique integer — gives
   the running aggregate inside the block;
2. each (key, block) is summarised by a partial aggregate — one row per block;
3. an exclusive prefix over the blocks of a key is taken on that small summary (in super-blocks, then over
   them) and joined back.

The summary (2) is a partial aggregate over its own read of the source, so it shuffles one row per task and
(key, block); the rows themselves are shuffled once, for the in-block window, and the join on (key, block) uses
that partitioning. All joins are null-safe: rows with a null key are a key of their own, as in ``PARTITION BY``.
Supported aggregates are the associative ones: ``sum``, ``count``, ``max``, ``min`` (``max``/``min`` also
on structs, for arg-max with tie rules) and ``first``/``last`` by arrival sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of the arrival sequence per block. Bounds the rows one window task sees for a hot key.
DEFAULT_BLOCK = 1 << 20

BLK = "_blk"
# Blocks per super-block: the prefix over a key's blocks is taken inside super-blocks, then over them.
SUPER = 1 << 12
SUP = "_sup"

_PARTIAL = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
_OVER_BLOCKS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, pre: Column, cur: Column) -> Column:
    if kind == "sum":
        return F.coalesce(pre + cur, pre, cur)
    if kind == "count":
        return F.coalesce(pre, F.lit(0)) + cur
    if kind == "max":
        return F.greatest(pre, cur)
    if kind == "min":
        return F.least(pre, cur)
    raise ValueError(kind)


def _carry(kind: str, base: Column, pre: Column) -> Column:
    """The value before a block: earlier data, then the earlier blocks of this data."""
    if kind == "first":
        return F.when(F.coalesce(F.col("_base_rows"), F.lit(0)) > 0, base).otherwise(pre)
    if kind == "last":
        return F.when(F.coalesce(F.col("_pre_rows"), F.lit(0)) > 0, pre).otherwise(base)
    return _combine("sum" if kind in ("sum", "count") else kind, base, pre)


def _carried(prefix: DataFrame, names: Sequence[str], kinds: Mapping[str, str], positional: Sequence[str]) -> DataFrame:
    """``prefix`` with the carried ``_base_*`` columns combined into its ``_pre_*`` columns."""
    return prefix.withColumns({
        **{f"_pre_{i}": _carry(kinds[n], F.col(f"_base_{i}"), F.col(f"_pre_{i}")) for i, n in enumerate(names)},
        **({"_pre_rows": F.coalesce("_pre_rows", F.lit(0)) + F.coalesce("_base_rows", F.lit(0))} if positional else {}),
    }).drop(*[f"_base_{i}" for i in range(len(names))], "_base_rows")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null (still a hash or merge join); keys come from ``left``."""
    names = {k: f"_r_{i}" for i, k in enumerate(keys)}
    cond = F.lit(True)
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(names[k]))
        cond = same if i == 0 else cond & same
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def with_block(df: DataFrame, seq_col: str, block: int) -> DataFrame:
    return df.withColumn(BLK, F.floor(F.col(seq_col) / F.lit(block)).cast("long"))


def keyed_running(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, Column]],
    seq_col: str = "seq",
    order_cols: Sequence[str] | None = None,
    inclusive: bool = True,
    block: int = DEFAULT_BLOCK,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add one column per entry of ``aggs`` = running aggregate per ``keys`` in ``order_cols`` order.

    ``base`` (optional): one row per key, as :func:`keyed_totals` gives it, with the values carried in
    from earlier data (e.g. previous micro-batches). It is joined to the small per-(key, block) prefix
    table, never to the rows, so a hot key costs nothing extra.

    ``aggs``: name → (kind, column expression); kinds ``sum``, ``count``, ``max``, ``min`` and
    ``first`` / ``last`` (the value at the least / greatest ``seq_col`` of the frame — these need
    ``order_cols`` to be ``[seq_col]``, a unique integer). ``seq_col`` blocks must be monotone in
    ``order_cols`` (default order: ``seq_col`` alone). ``inclusive=False`` gives the aggregate over the
    rows strictly before the current one (null/0 for the first row of a key). With ``keys=[]`` the scan
    is global, and the prefix over blocks runs over the per-block summary only.

    ``first``/``last`` use ``min_by``/``max_by`` on a primitive value, so the per-block summary stays a
    hash aggregate; a struct ``max`` works too but its buffer forces a sort-based aggregate.
    """
    keys = list(keys)
    order_cols = list(order_cols or [seq_col])
    names = list(aggs)
    kinds = {n: aggs[n][0] for n in names}
    positional = [n for n in names if kinds[n] in ("first", "last")]
    if positional and order_cols != [seq_col]:
        raise ValueError("first/last need order_cols == [seq_col]")
    tmp = {n: f"_agg_{i}" for i, n in enumerate(names)}
    d = with_block(df, seq_col, block).withColumns({tmp[n]: aggs[n][1] for n in names})
    seq = F.col(seq_col)

    def part(n: str, c: Column) -> Column:
        k = kinds[n]
        if k == "first":
            return F.min_by(c, seq)
        if k == "last":
            return F.max_by(c, seq)
        return _PARTIAL[k](c)

    aux = [F.count(F.lit(1)).alias("_rows")] if positional else []
    totals = d.groupBy(*keys, BLK).agg(*[part(n, F.col(tmp[n])).alias(tmp[n]) for n in names], *aux,
                                       *([F.min(seq).alias("_s0"), F.max(seq).alias("_s1")] if positional else []))
    totals = totals.withColumn(SUP, F.floor(F.col(BLK) / F.lit(SUPER)).cast("long"))

    def before(rows: DataFrame, by: list[str], order: str, names_out: str) -> list[Column]:
        """Exclusive prefix of the summary rows in ``order``, as ``<names_out>i`` and ``<names_out>rows``."""
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

        def over(n: str) -> Column:
            k = kinds[n]
            if k == "first":
                return F.min_by(F.col(tmp[n]), F.col("_s0")).over(w)
            if k == "last":
                return F.max_by(F.col(tmp[n]), F.col("_s1")).over(w)
            return _OVER_BLOCKS[k](F.col(tmp[n])).over(w)

        return [*[over(n).alias(f"{names_out}{i}") for i, n in enumerate(names)],
                *([F.sum("_rows").over(w).alias(f"{names_out}rows")] if positional else [])]

    def merged(n: str) -> Column:
        k = kinds[n]
        if k == "first":
            return F.min_by(F.col(tmp[n]), F.col("_s0"))
        return F.max_by(F.col(tmp[n]), F.col("_s1")) if k == "last" else _OVER_BLOCKS[k](F.col(tmp[n]))

    # two levels, so that the blocks of a hot key are not one task either
    tops = totals.groupBy(*keys, SUP).agg(*[merged(n).alias(tmp[n]) for n in names], *(
        [F.sum("_rows").alias("_rows"), F.min("_s0").alias("_s0"), F.max("_s1").alias("_s1")] if positional else []))
    tops = tops.select(*keys, SUP, *before(tops, keys, SUP, "_base_"))
    prefix = totals.select(*keys, SUP, BLK, *before(totals, [*keys, SUP], BLK, "_pre_"))
    prefix = _carried(join_null_safe(prefix, tops, [*keys, SUP]), names, kinds, positional).drop(SUP)
    if base is not None:
        b = base.select(*keys, *[F.col(n).alias(f"_base_{i}") for i, n in enumerate(names)],
                        *([F.col("_rows").alias("_base_rows")] if positional else []))
        prefix = _carried(join_null_safe(prefix, b, keys, "left"), names, kinds, positional)

    in_block = Window.partitionBy(*keys, BLK).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = join_null_safe(d, prefix, [*keys, BLK])
    cols = {}
    for i, n in enumerate(names):
        k, pre = kinds[n], F.col(f"_pre_{i}")
        cur = part(n, F.col(tmp[n])).over(in_block)
        if k == "first":
            cols[n] = F.when(F.coalesce(F.col("_pre_rows"), F.lit(0)) > 0, pre).otherwise(cur)
        elif k == "last":
            cols[n] = F.when(F.count(F.lit(1)).over(in_block) > 0, cur).otherwise(pre)
        else:
            cols[n] = _combine(k, pre, cur)
    out = out.withColumns(cols)
    return out.drop(BLK, *tmp.values(), *[f"_pre_{i}" for i in range(len(names))], *(["_pre_rows"] if positional else []))


def keyed_totals(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, Column]], seq_col: str = "seq",
                 base: DataFrame | None = None) -> DataFrame:
    """One row per key of ``df``: the value of every aggregate after the last row (and ``_rows``), the carry
    for :func:`keyed_running` on later data. ``base``: the carry from earlier data."""
    part = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "first": lambda c: F.min_by(c, F.col(seq_col)),
            "last": lambda c: F.max_by(c, F.col(seq_col))}
    now = df.groupBy(*keys).agg(*[part[k](c).alias(n) for n, (k, c) in aggs.items()], F.count(F.lit(1)).alias("_rows"))
    if base is None:
        return now
    b = base.select(*keys, *[F.col(n).alias(f"_base_{n}") for n in aggs], F.col("_rows").alias("_base_rows"))
    out = {}
    for n, (kind, _) in aggs.items():
        if kind == "first":
            out[n] = F.when(F.coalesce(F.col("_base_rows"), F.lit(0)) > 0, F.col(f"_base_{n}")).otherwise(F.col(n))
        elif kind != "last":
            out[n] = _combine("sum" if kind in ("sum", "count") else kind, F.col(f"_base_{n}"), F.col(n))
    out["_rows"] = F.col("_rows") + F.coalesce("_base_rows", F.lit(0))
    return join_null_safe(now, b, keys, "left").withColumns(out).select(*now.columns)


@dataclass(frozen=True)
class Running:
    """A running keyed aggregation, one output row (or a few) per record: the same description runs on a table
    (:meth:`run`) and, with the totals carried from batch to batch, on a stream (``tempest.streaming.folds``)."""

    keys: tuple[str, ...]
    aggs: Mapping[str, tuple[str, Column]]
    project: Callable[[DataFrame], DataFrame]
    inclusive: bool = True
    seq: str = "seq"

    def run(self, df: DataFrame, base: DataFrame | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
        return self.project(keyed_running(df, self.keys, self.aggs, self.seq, inclusive=self.inclusive, block=block, base=base))

    def totals(self, df: DataFrame, base: DataFrame | None = None) -> DataFrame:
        return keyed_totals(df, self.keys, self.aggs, self.seq, base)


def last_rows_frame(ranked: DataFrame, keys: Sequence[str], rank: str, size: int, aggs: Mapping[str, Column],
                    block: int = 1 << 16) -> DataFrame:
    """Aggregates over each row and the ``size - 1`` before it, by position ``rank`` (1, 2, ... in each key).

    Positions are cut into blocks; only the last ``size - 1`` rows of a block are sent to the next one as well
    (``1 + size / block`` copies in all), so a hot key is many bounded windows."""
    if size > block:
        raise ValueError("a block must hold a frame")
    blk = F.floor((F.col(rank) - 1) / F.lit(block)).cast("long")
    edge = F.pmod(F.col(rank) - 1, F.lit(block)) >= block - size + 1
    d = ranked.withColumn("_own", blk).withColumn("_b", F.explode(F.when(edge, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(*keys, "_b").orderBy(rank).rowsBetween(-(size - 1), 0)
    return d.withColumns({n: c.over(w) for n, c in aggs.items()}).where(F.col("_b") == F.col("_own")).drop("_b", "_own")


def latest_rows(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key in ``order_cols`` order. Spark takes ``n`` rows of a key from each task before the
    shuffle (a window group limit, up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot key is small."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_cols])
    return df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= n).drop("_back")


def keyed_rank(df: DataFrame, keys: Sequence[str], seq_col: str = "seq", order_cols: Sequence[str] | None = None,
               name: str = "rn", block: int = DEFAULT_BLOCK) -> DataFrame:
    """1-based position of each row within its key in arrival order (a hot-key-safe ``row_number``)."""
    return keyed_running(df, keys, {name: ("count", F.lit(1))}, seq_col, order_cols, True, block)


def previous_row(df: DataFrame, keys: Sequence[str], fields: Sequence[str], seq_col: str = "seq",
                 prefix: str = "prev_", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``lag(field, 1)`` per key in ``seq_col`` order, for each of ``fields``, without a per-key window:
    the value at the greatest ``seq`` before the current row (an associative running ``last``)."""
    aggs = {f"{prefix}{f}": ("last", F.col(f)) for f in fields}
    return keyed_running(df, keys, aggs, seq_col, [seq_col], inclusive=False, block=block)


def keyed_rank_by(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], name: str = "rn",
                  partitions: int | None = None) -> DataFrame:
    """1-based position of each row within its key in any ``order_cols`` order, hot-key safe.

    The data is range-partitioned on (keys, order) — a hot key is split over several partitions by
    its order values — and sorted within partitions; ``monotonically_increasing_id`` then carries the
    partition number and the position in it. That table is written once (so every use sees the same
    numbering), and the rank is the key's row count in earlier partitions (a prefix over a summary of
    one row per key and partition) plus the position inside the partition.
    """
    from tempest.session import materialize

    keys, order_cols = list(keys), list(order_cols)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *keys, *order_cols).sortWithinPartitions(*keys, *order_cols)
    d = materialize(d.withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    d = d.withColumn("_pid", F.shiftright("_mid", 33))
    summary = d.groupBy(*keys, "_pid").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_pid", "_m0", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    out = join_null_safe(d, summary, [*keys, "_pid"])
    return out.withColumn(name, F.col("_before") + (F.col("_mid") - F.col("_m0")) + 1).drop("_mid", "_pid", "_m0", "_before")
