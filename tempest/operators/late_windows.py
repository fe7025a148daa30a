"""Event-time tumbling windows with a bounded-out-of-orderness watermark, allowed lateness and a
late-data output (W6, P2-P4), as a batch job.

Rule (per-record watermark): before a row is processed, ``wm = max(ts of the rows that arrived
before it) - delay``. A row whose window ``[s, e)`` satisfies ``e - 1ms + lateness <= wm`` is late and
goes to the late output; every other row is folded into its window. With whole-second times that is
``max_ts_before >= e + lateness + delay``.

The watermark is a running max over the *global* arrival order. A global window would run in one
task, so it is a block scan with no key: per-block maxima (partial aggregate), an exclusive prefix
over the few block rows, then a running max inside each block of ``block`` arrival positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.operators.scan import DEFAULT_BLOCK, keyed_running
from tempest.session import materialize


def flag_late(df: DataFrame, size: int, delay: int, lateness: int, arrival: str = "arrival",
              order_cols: Sequence[str] | None = None, ts: str = "timestamp", block: int = DEFAULT_BLOCK, top: int | None = None) -> DataFrame:
    """Add ``window_start``, ``window_end`` (epoch s), ``wm_before`` (s) and ``is_late``. ``top``: the largest event
    time of rows that arrived before all of ``df``."""
    order_cols = list(order_cols or [arrival])
    d = keyed_running(df, [], {"_max_before": ("max", F.col(ts))}, arrival, order_cols, inclusive=False, block=block)
    if top is not None:
        d = d.withColumn("_max_before", F.greatest(F.col("_max_before"), F.lit(top).cast("long")))
    start = F.floor(F.col(ts) / F.lit(size)).cast("long") * F.lit(size)
    d = d.withColumns({"window_start": start, "window_end": start + F.lit(size)})
    return d.withColumns({
        "wm_before": F.col("_max_before") - F.lit(delay),
        "is_late": F.coalesce(F.col("_max_before") >= F.col("window_end") + F.lit(lateness + delay), F.lit(False)),
    }).withColumnRenamed("_max_before", "max_ts_before")


def late_window_min_by(df: DataFrame, size: int = 5, delay: int = 2, lateness: int = 60, key: str = "id",
                       field: str = "temperature", arrival: str = "arrival", order_cols: Sequence[str] | None = None,
                       ts: str = "timestamp", seq: str = "seq", block: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """``keyBy(key).timeWindow(size).allowedLateness(lateness).sideOutputLateData(tag).minBy(field)``.

    Returns ``(main, late)``: ``main`` is the final state of each (key, window) — the record with the
    least ``field``, the earliest arrival on ties — and ``late`` the rows sent to the side output.
    The per-window result is a partial (map-side combined) aggregate, so a hot key is no problem.
    """
    order_cols = list(order_cols or [arrival, seq])
    d = flag_late(df, size, delay, lateness, arrival, order_cols, ts, block)
    # null readings sort after every number (a null never beats a real minimum), then arrival order
    best = F.min(F.struct(F.col(field).isNull().alias("_null"), F.col(field).alias("_v"),
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                          F.col(seq).alias("_seq"), F.col(ts).alias("_ts")))
    main = (
        d.where(~F.col("is_late"))
        .groupBy(key, "window_end")
        .agg(best.alias("_b"))
        .select(key, "window_end", F.col("_b._seq").alias(seq), F.col("_b._ts").alias(ts), F.col("_b._v").alias(field))
    )
    late = d.where(F.col("is_late")).select(seq, key, ts, field)
    return main, late


@dataclass(frozen=True)
class LateStep:
    """What a run of rows (in arrival order) brings: late rows, firings, and the windows still open after it."""

    late: DataFrame
    firings: DataFrame
    windows: DataFrame


def window_firings(d: DataFrame, key: str, seq: str, ts: str, field: str) -> DataFrame:
    return d.select(key, "window_end", F.col("best.s").alias(seq), F.col("best.t").alias(ts), F.col("best.v").alias(field), "emitted_after")


def late_window_step(df: DataFrame, size: int, delay: int, lateness: int, key: str = "id", field: str = "temperature",
                     arrival: str = "arrival", ts: str = "timestamp", seq: str = "seq", block: int = DEFAULT_BLOCK, top: int | None = None,
                     windows: DataFrame | None = None, staged: Callable[[DataFrame, str], DataFrame] = materialize) -> LateStep:
    """The per-record replay of the rows ``df``, given what came before: ``top``, the largest event time, and ``windows``
    (key, window_end, best, fired), the open windows. The result's ``windows`` are those that a later row can still reach.

    * A window first fires when the watermark passes its end: right after the first row (in arrival
      order) that lifts the running max of event time to ``end + delay`` — its *crossing* row — if
      the window already holds a row; its content is the arg-min over the rows that arrived before.
    * A non-late row arriving once the window is due fires it again (on arrival), with the arg-min
      including itself.

    Crossings: the rows that lift the running max over a multiple of ``size`` are steps; a window end is crossed by
    the smallest step at or above it, found for the window ends that exist only, by one scan over both in
    descending order. Since the running max never decreases, "arrived before the crossing" is a test on
    each row. Re-firings use the running arg-min per (key, window) from the block scan. The flagged rows
    are written once and feed every branch.
    """
    order, ks = [arrival, seq], [key, "window_end"]
    d = staged(flag_late(df.select(*dict.fromkeys([key, ts, field, arrival, seq])), size, delay, lateness, arrival, order, ts, block, top), "flagged")
    # null readings sort after every number, then arrival order
    best_of = F.struct(F.col(field).isNull().alias("null"), F.col(field).alias("v"), F.col(arrival).alias("a"), F.col(seq).alias("s"), F.col(ts).alias("t"))
    kept = d.where(~F.col("is_late"))
    # the running max never decreases, so "arrived before the crossing row" is a test on the row itself
    before = F.greatest(F.col("max_ts_before"), F.col(ts)) < F.col("window_end") + F.lit(delay)
    now = kept.groupBy(*ks).agg(F.max(before).alias("_has"), F.min(F.when(before, best_of)).alias("_b"), F.min(best_of).alias("_all"))
    if windows is None:
        now = now.withColumn("_was", F.lit(False))
    else:
        names = {c: f"_o_{c}" for c in windows.columns}
        same = F.col(key).eqNullSafe(F.col(f"_o_{key}")) & (F.col("window_end") == F.col("_o_window_end"))
        now = now.withColumn("_in", F.lit(True)).join(windows.withColumnsRenamed(names), same, "full")
        now = now.select(F.when(F.col("_in"), F.col(key)).otherwise(F.col(f"_o_{key}")).alias(key), F.coalesce("window_end", "_o_window_end").alias("window_end"),
                         (F.coalesce("_has", F.lit(False)) | F.col("_o_best").isNotNull()).alias("_has"), F.least("_b", "_o_best").alias("_b"),
                         F.least("_all", "_o_best").alias("_all"), F.coalesce("_o_fired", F.lit(False)).alias("_was"))
        now = staged(now, "windows")

    # watermark crossings of window ends (late rows move the watermark too), in units of the window size
    hi = F.floor((F.greatest(F.col("max_ts_before"), F.col(ts)) - F.lit(delay)) / F.lit(size))
    below = F.floor((F.col("max_ts_before") - F.lit(delay)) / F.lit(size))
    steps = d.where(F.col("max_ts_before").isNull() | (hi > below)).groupBy((-hi).cast("long").alias("_v")).agg(
        F.min(F.struct(F.col(arrival), F.col(seq))).alias("_m")).select("_v", F.lit(0).alias("_kind"), F.col(f"_m.{seq}").alias("_s"))
    ends = now.select((-F.col("window_end") / F.lit(size)).cast("long").alias("_v")).distinct()
    both = steps.unionByName(ends.select("_v", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_s")))
    at = F.when(F.col("_kind") == 0, F.struct(F.col("_v").alias("v"), F.col("_s").alias("s")))
    scan = keyed_running(both, [], {"_x": ("max", at)}, "_v", ["_v", "_kind"], True, block)
    crossings = scan.where("_kind = 1").select((-F.col("_v") * F.lit(size)).alias("window_end"), F.col("_x.s").alias("emitted_after"))

    reached = F.greatest(d.agg(F.max(ts)).scalar(), F.lit(top).cast("long"))
    now = now.withColumn("_crossed", F.coalesce(F.col("window_end") + F.lit(delay) <= reached, F.lit(False)))
    first = (now.where(F.col("_crossed") & ~F.col("_was") & F.col("_has")).join(crossings, "window_end", "left")  # summary-sized join
             .select(*ks, F.col("_b").alias("best"), "emitted_after"))
    due = F.col("max_ts_before") >= F.col("window_end") + F.lit(delay)  # wm >= end - 1 ms on arrival
    base = None if windows is None else windows.select(*ks, "best")
    again = keyed_running(kept, ks, {"best": ("min", best_of)}, arrival, order, True, block, base)
    again = again.where(F.coalesce(due, F.lit(False))).select(*ks, "best", F.col(seq).alias("emitted_after"))
    closed = F.coalesce(F.col("window_end") + F.lit(lateness + delay) <= reached, F.lit(False))
    open_ = now.where(~closed & F.col("window_end").isNotNull()).select(*ks, F.col("_all").alias("best"), F.col("_crossed").alias("fired"))
    return LateStep(d.where(F.col("is_late")).select(seq, key, ts, field), window_firings(first.unionByName(again), key, seq, ts, field), open_)


def late_window_emissions(df: DataFrame, size: int = 5, delay: int = 2, lateness: int = 60, key: str = "id",
                          field: str = "temperature", arrival: str = "arrival", ts: str = "timestamp", seq: str = "seq",
                          flush_at_end: bool = False, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Every firing of the windows, as the per-record replay emits them (see :func:`late_window_step`): ``(id,
    window_end, seq, timestamp, temperature, emitted_after)`` — the window's best record at that moment, and the ``seq``
    of the row after which it fired. ``flush_at_end``: windows the watermark never passed fire once at the end of the
    bounded input (``emitted_after`` null), as a bounded source's final watermark does."""
    s = late_window_step(df, size, delay, lateness, key, field, arrival, ts, seq, block)
    if not flush_at_end:
        return s.firings
    rest = s.windows.where(~F.col("fired")).withColumn("emitted_after", F.lit(None).cast("long"))
    return s.firings.unionByName(window_firings(rest, key, seq, ts, field))
