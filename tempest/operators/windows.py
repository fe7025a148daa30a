"""Time windows (tumbling, sliding), group windows of the table API/SQL, and OVER row windows.

Window ends are returned as BIGINT epoch seconds (exclusive end, as ``TimeWindow.getEnd`` and
``TUMBLE_END``). All grouped windows are built-in hash aggregates with map-side combining.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tempest.operators.scan import keyed_rank_by, last_rows_frame
from tempest.readings import with_rowtime


def _dur(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def window_end(col: str = "window") -> F.Column:
    return F.unix_seconds(F.col(f"{col}.end"))


def tumble_count(df: DataFrame, size: int = 15, key: str = "id", ts: str = "timestamp") -> DataFrame:
    """``keyBy(id).timeWindow(size).aggregate(count)``: count per key and tumbling window."""
    d = with_rowtime(df, ts, "_rt")
    return (
        d.groupBy(key, F.window("_rt", _dur(size)).alias("window"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(key, window_end().alias("window_end"), "cnt")
    )


def slide_count(df: DataFrame, size: int = 15, slide: int = 5, key: str = "id", ts: str = "timestamp") -> DataFrame:
    """``timeWindow(size, slide).apply(count)`` → ``(id, windowEnd, count)``; only non-empty windows."""
    d = with_rowtime(df, ts, "_rt")
    return (
        d.groupBy(key, F.window("_rt", _dur(size), _dur(slide)).alias("window"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(key, window_end().alias("window_end"), "cnt")
    )


def tumble_sum_first(df: DataFrame, size: int = 15, key: str = "id", field: str = "temperature",
                     ts: str = "timestamp", seq: str = "seq") -> DataFrame:
    """``timeWindow(size).sum(field)``: the window's first record (by ``seq``) with ``field`` summed."""
    d = with_rowtime(df, ts, "_rt")
    return (
        d.groupBy(key, F.window("_rt", _dur(size)).alias("window"))
        .agg(F.sum(field).alias("_sum"), F.min(seq).alias("first_seq"), F.min_by(ts, seq).alias(ts))
        .select(key, window_end().alias("window_end"), "first_seq", ts, F.col("_sum").alias(field))
    )


def tumble_count_avg(df: DataFrame, size: int = 10, key: str = "id", field: str = "temp",
                     rowtime: str = "rt") -> DataFrame:
    """Group window ``Tumble.over(size).on(rt)``, ``groupBy(id, tw)``: ``id.count, temp.avg, tw.end``."""
    return (
        df.groupBy(key, F.window(rowtime, _dur(size)).alias("window"))
        .agg(F.count(key).alias("cnt"), F.avg(field).alias("avg_temp"))
        .select(key, "cnt", "avg_temp", window_end().alias("window_end"))
    )


_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def window_ends(df: DataFrame, size: int, slide: int | None = None, ts: str = "timestamp") -> DataFrame:
    """``window_end`` (epoch seconds, exclusive) of each row; a row of a sliding window once per window."""
    d = with_rowtime(df, ts, "_rt")
    return d.select("*", F.window("_rt", _dur(size), _dur(slide or size)).alias("_w")).withColumn(
        "window_end", window_end("_w")).drop("_w", "_rt")


def partial_accumulators(df: DataFrame, keys: list[str], accumulators: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Create and add: one accumulator row per group."""
    return df.groupBy(*keys).agg(*[_PARTIAL[k](c).alias(n) for n, (k, c) in accumulators.items()])


def merge_accumulators(parts: DataFrame, keys: list[str], accumulators: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Merge accumulator rows of the same group."""
    return parts.groupBy(*keys).agg(*[_MERGE[k](F.col(n)).alias(n) for n, (k, _) in accumulators.items()])


def group_window(df: DataFrame, size: int, accumulators: Mapping[str, tuple[str, Column]], results: Mapping[str, Column],
                 slide: int | None = None, key: str = "id", ts: str = "timestamp") -> DataFrame:
    """``timeWindow(...).aggregate(AggregateFunction)`` with a user accumulator, as column expressions:
    ``accumulators`` name → (``sum``/``count``/``min``/``max``, per-record column; structs for arg-min/max) say how
    records are added and accumulators merged (so Spark combines map-side), ``results`` the output from them."""
    d = partial_accumulators(window_ends(df, size, slide, ts), [key, "window_end"], accumulators)
    return d.select(key, "window_end", *[c.alias(n) for n, c in results.items()])


def window_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, size: int, slide: int | None = None,
                 key: str = "id", ts: str = "timestamp") -> DataFrame:
    """Full-window function of a pandas frame: ``fn`` receives the rows of a (key, window), with ``window_end``, and returns
    rows of ``schema``. The whole window of one key is handed to one call; for large windows use :func:`window_process`."""
    return window_ends(df, size, slide, ts).groupBy(key, "window_end").applyInPandas(fn, schema)


#: Buckets that windows are dealt to, for each shuffle partition.
BUCKETS = 16


class WindowFunction(Protocol):
    """A user's full-window function, made anew for each window: it is given the window's rows in order, an Arrow batch
    at a time, and then asked for its result rows (dicts)."""

    def add(self, rows: pa.RecordBatch) -> None: ...

    def result(self) -> list[dict]: ...


def window_process(df: DataFrame, function: Callable[[], WindowFunction], schema: str, size: int, slide: int | None = None,
                 key: str = "id", ts: str = "timestamp", order: Sequence[str] = ()) -> DataFrame:
    """Full-window function (``WindowFunction.apply``) over every (key, window): rows ``(key, window_end, *schema)``.
    ``function()`` gives the object that sees a window's rows sorted by ``order``, with ``window_rows``, their number. The
    rows come out of Spark's own (spilling) sort batch by batch, so a window is never held as a whole: how much of it the
    function keeps is its own affair. Use it when no built-in aggregate expresses the function.

    Windows are dealt to buckets by hash, and a bucket is one group with Spark: its many small windows share their Arrow
    batches, and the rows are shuffled and sorted once (the number of rows comes from a window over the same order)."""
    d = window_ends(df, size, slide, ts)
    ks = [key, "window_end"]
    out = StructType([*d.select(*ks).schema, *StructType.fromDDL(schema)])
    buckets = BUCKETS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.withColumn("_bucket", F.pmod(F.xxhash64(*ks), F.lit(buckets))).repartition("_bucket")
    w = Window.partitionBy("_bucket", *ks)
    w = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing) if order else w
    # the grouping below needs this distribution and these leading sort columns: no further exchange or sort
    counted = d.withColumn("window_rows", F.count(F.lit(1)).over(w))
    seen = [c for c in counted.columns if c != "_bucket"]
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, place, rows = None, {}, []
        for rb in batches:
            if not rb.num_rows:
                continue
            rb = rb.select(seen)
            # sorted rows: a window's are together, and one ends where its number of rows is reached
            at = 0
            while at < rb.num_rows:
                if f is None:
                    f, place, left = function(), {k: rb.column(k)[at].as_py() for k in ks}, rb.column("window_rows")[at].as_py()
                n = min(left, rb.num_rows - at)
                f.add(rb.slice(at, n))
                at, left = at + n, left - n
                if not left:
                    rows += [place | r for r in f.result()]
                    f = None
                if len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return counted.groupBy("_bucket").applyInArrow(run, out)


class Median:
    """The median of a window's ``field``, for rows sorted by it (nulls last): keeps the middle values only."""

    def __init__(self, field: str = "temperature"):
        self.field, self.seen, self.middle = field, 0, []

    def add(self, rows: pa.RecordBatch) -> None:
        n = rows.column("window_rows")[0].as_py()
        for at in {(n - 1) // 2, n // 2}:
            if self.seen <= at < self.seen + rows.num_rows:
                self.middle.append(rows.column(self.field)[at - self.seen].as_py())
        self.seen += rows.num_rows

    def result(self) -> list[dict]:
        return [{"rows": self.seen, "median": sum(self.middle) / len(self.middle)}]


def window_median(df: DataFrame, size: int, key: str = "id", field: str = "temperature", ts: str = "timestamp") -> DataFrame:
    """``(key, window_end, rows, median)`` of the readings that are not null."""
    return window_process(df.where(F.col(field).isNotNull()), lambda: Median(field), "rows long, median double", size, key=key, ts=ts, order=[field])


def over_rows(df: DataFrame, preceding: int = 2, key: str = "id", field: str = "temp", ts: str = "ts",
              seq: str = "seq", partitions: int | None = None) -> DataFrame:
    """``Over.partitionBy(id).orderBy(rt).preceding(n rows)``: ``count`` and ``avg`` over the current
    row and the ``n`` before it, in event-time order (ties by ``seq``).

    Hot-key-safe: the row's position ``rn`` within its key comes from :func:`keyed_rank_by` (range
    partitioning on (key, time, seq)); the frame is a row window over bounded blocks of positions.
    """
    ranked = keyed_rank_by(df.select(key, seq, ts, field), [key], [ts, seq], name="_rn", partitions=partitions)
    out = last_rows_frame(ranked, [key], "_rn", preceding + 1, {"cnt": F.count(F.col(key)), "avg_temp": F.avg(field)})
    return out.select(key, ts, seq, "cnt", "avg_temp")
