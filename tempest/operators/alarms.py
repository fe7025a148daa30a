"""Keyed-state alarms: temperature jumps (P9) and sustained rises (P10), on tables and (``folds.run_keyed``) on streams."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tempest.functions.java import java_lt
from tempest.operators.blockfold import each_group, whole_groups
from tempest.operators.scan import BLK, DEFAULT_BLOCK, SUP, Running, join_null_safe, keyed_running, with_block
from tempest.session import materialize

# The rise-alarm message `传感器<id>温度值连续<interval>s上升`, and the initial
# "last temperature" (Double.MIN_VALUE, the smallest positive double).
RISE_MESSAGE_PARTS = ("传感器", "温度值连续", "s上升")
RISE_INITIAL_LAST = 4.9e-324


def jump_spec(threshold: float = 10.0, key: str = "id", field: str = "temperature", seq: str = "seq") -> Running:
    last, cur = F.col("_prev"), F.col(field)
    diff = F.abs(cur - last)
    # the JDK's >= is false for NaN; Spark orders NaN above every number
    hit = last.isNotNull() & ~F.isnan(diff) & (diff >= F.lit(threshold))
    return Running((key,), {"_prev": ("last", cur)}, lambda d: d.where(hit).select(key, seq, last.alias("last_temp"), cur.alias(field)),
                   inclusive=False, seq=seq)


def jump_alarm(df: DataFrame, threshold: float = 10.0, key: str = "id", field: str = "temperature",
               seq: str = "seq", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Per key, alarm ``(id, last, cur)`` when ``|cur - last| >= threshold``; the first reading of a
    key never alarms."""
    return jump_spec(threshold, key, field, seq).run(df, block=block)


#: Records that one call of the timer machine sees at most, and blocks whose machines are composed into one.
RISE_ROWS, RISE_SUPER = 1 << 16, 1 << 6


def replay(t: list, rise: list, fall: list, interval: int, fire: int | None, begin: int = 0) -> tuple[list[tuple[int, int]], int | None]:
    """The timer machine over records ``begin`` to the end, from the armed time ``fire`` (None: no timer): the alarms as
    (record, fire time) and the timer left. A record past the armed time fires it; then a rise without a timer arms ``t +
    interval``, and a fall cancels a timer."""
    out = []
    for i in range(begin, len(t)):
        x = t[i]
        if fire is not None and x is not None and x > fire:
            out.append((i, fire))
            fire = None
        if rise[i]:
            if fire is None and x is not None:
                fire = x + interval
        elif fall[i]:
            fire = None
    return out, fire


#: Runs that are left, when the others have ended, to be replayed one by one.
FEW_RUNS = 32


@dataclass(frozen=True)
class Records:
    """Times (with ``known``: not null), rises and falls of records, as arrays."""

    t: np.ndarray
    known: np.ndarray
    rise: np.ndarray
    fall: np.ndarray

    @staticmethod
    def of(rb: pa.RecordBatch) -> "Records":
        t, rise, fall = (rb.column(c) for c in ("_t", "_rise", "_fall"))
        return Records(t.fill_null(0).to_numpy(), t.is_valid().to_numpy(zero_copy_only=False),
                       *(x.fill_null(False).to_numpy(zero_copy_only=False) for x in (rise, fall)))

    def lists(self, a: int, b: int) -> tuple[list, list, list]:
        """Records ``a`` to ``b`` as :func:`replay` takes them."""
        t = [x if k else None for x, k in zip(self.t[a:b].tolist(), self.known[a:b].tolist())]
        return t, self.rise[a:b].tolist(), self.fall[a:b].tolist()

    def replayed(self, begin: np.ndarray, end: np.ndarray, interval: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """:func:`replay` of many runs of records at once, each without a timer at first: (the records that fire, in order;
        their fire times; whether a run leaves a timer; its time). Step k takes the k-th record of every run that has one."""
        order = np.argsort(begin - end, kind="stable")  # the longest first
        at0, size = begin[order], (end - begin)[order]
        armed, fire = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
        hits, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        k = 0
        while (m := int(np.searchsorted(-size, -k))) > FEW_RUNS:
            at = at0[:m] + k
            x, known, a, f = self.t[at], self.known[at], armed[:m], fire[:m]
            over = a & known & (x > f)
            hits.append(at[over])
            times.append(f[over])
            a &= ~over
            arm = self.rise[at] & known & ~a
            f[arm] = x[arm] + interval
            a |= arm
            a &= ~self.fall[at]
            k += 1
        for i in range(m):
            first = int(at0[i]) + k
            out, left = replay(*self.lists(first, first + int(size[i]) - k), interval, int(fire[i]) if armed[i] else None)
            hits.append(np.array([first + j for j, _ in out], np.int64))
            times.append(np.array([f for _, f in out], np.int64))
            armed[i], fire[i] = left is not None, left or 0
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        hit, time = np.concatenate(hits), np.concatenate(times)
        by = np.argsort(hit)
        return hit[by], time[by], armed[back], fire[back]


@dataclass(frozen=True)
class TimerMap:
    """What a run of records does to a timer: armed time before → armed time after.

    A run with a fall leaves the same timer whatever it began with (``always``: only ``idle`` counts, what is left
    where no timer was armed). Otherwise an armed time below ``bounds[i]`` (the first such i: the record that fires it is the
    first whose time is a new largest one) leaves ``outs[i]``, and one of ``bounds[-1]`` or more stays armed."""

    always: bool
    idle: int | None
    bounds: list[int]
    outs: list

    def __call__(self, fire: int | None) -> int | None:
        if fire is None or self.always:
            return self.idle
        i = bisect_right(self.bounds, fire)
        return self.outs[i] if i < len(self.outs) else fire

    @staticmethod
    def of(t: list, rise: list, fall: list, interval: int) -> "TimerMap":
        if any(fall):
            last = len(fall) - 1 - fall[::-1].index(True)
            # the record of a fall leaves no timer; only what comes after it can arm one
            return TimerMap(True, replay(t, rise, fall, interval, None, last + 1)[1], [], [])
        n = len(t)
        armed, after = [None] * n, [None] * (n + 1)  # left at the end if armed at i; if nothing is armed before record i
        low, at = [], []  # records that are larger than all between, nearest last: their times negated, their places
        for i in range(n - 1, -1, -1):
            if t[i] is not None and rise[i]:
                p = bisect_left(low, -(t[i] + interval))  # the nearest later record past the armed time
                if p == 0:
                    armed[i] = t[i] + interval
                else:
                    k = at[p - 1]
                    armed[i] = armed[k] if rise[k] else after[k + 1]
                after[i] = armed[i]
            else:
                after[i] = after[i + 1]
            if t[i] is not None:
                while low and -low[-1] <= t[i]:
                    low.pop()
                    at.pop()
                low.append(-t[i])
                at.append(i)
        bounds, outs = [], []
        for i in reversed(at):  # the records with a new largest time, in order
            left = armed[i] if rise[i] else after[i + 1]
            if outs and outs[-1] == left:
                bounds[-1] = t[i]
            else:
                bounds.append(t[i])
                outs.append(left)
        return TimerMap(False, after[0], bounds, outs)

    def then(self, later: "TimerMap") -> "TimerMap":
        """This run and then ``later``. Its bounds are those of both, so they stay within the records of one interval."""
        if self.always or later.always:
            return TimerMap(True, later(self.idle), [], [])
        top = self.bounds[-1] if self.bounds else None
        more = [i for i, b in enumerate(later.bounds) if top is None or b > top]
        bounds, outs = [], []
        for b, left in zip([*self.bounds, *(later.bounds[i] for i in more)], [*map(later, self.outs), *(later.outs[i] for i in more)]):
            if outs and outs[-1] == left:
                bounds[-1] = b
            else:
                bounds.append(b)
                outs.append(left)
        return TimerMap(False, later(self.idle), bounds, outs)


_MAP = ("always", "idle", "bounds", "outs")
_MAP_SQL = "always boolean, idle long, bounds array<long>, outs array<long>"


def _maps(cols: dict[str, list]) -> list[TimerMap]:
    return [TimerMap(*m) for m in zip(*(cols[c] for c in _MAP))]


def _first_look(rb: pa.RecordBatch, starts: np.ndarray, key: str, seq: str, interval: int, kinds: pa.Schema) -> pa.RecordBatch:
    """A row for each block (a group of ``rb`` from ``starts``): its map, its records up to the first fall and, as a fall leaves no
    timer, the alarms after that. All blocks of the batch are looked at together, but for the maps of those without a fall."""
    r = Records.of(rb)
    n, blocks = rb.num_rows, len(starts)
    ends = np.append(starts[1:], n)
    group = np.repeat(np.arange(blocks), ends - starts)
    falls = np.flatnonzero(r.fall)
    lo, hi = np.searchsorted(falls, starts), np.searchsorted(falls, ends)
    some = hi > lo
    cut = ends.copy()
    cut[some] = falls[lo[some]] + 1
    stop = ends[group[falls]]  # a run goes on to the next fall, or to the end of its block
    stop[:-1] = np.minimum(stop[:-1], falls[1:] + 1)
    at, fired, armed, fire = r.replayed(falls + 1, stop, interval)
    idle: list = [None] * blocks
    for g in np.flatnonzero(some)[armed[hi[some] - 1]].tolist():
        idle[g] = int(fire[hi[g] - 1])
    bounds: list[list] = [[]] * blocks
    outs: list[list] = [[]] * blocks
    for g in np.flatnonzero(~some).tolist():
        m = TimerMap.of(*r.lists(int(starts[g]), int(ends[g])), interval)
        idle[g], bounds[g], outs[g] = m.idle, m.bounds, m.outs

    def lists(name: str, sizes: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values, type=kinds.field(name).type)

    first = pa.array(starts)
    head = pa.array(np.arange(n) < cut[group])
    later = np.bincount(group[at], minlength=blocks)
    made = {
        key: rb.column(key).take(first), BLK: rb.column(BLK).take(first), "always": pa.array(some), "idle": pa.array(idle, pa.int64()),
        "bounds": pa.array(bounds, kinds.field("bounds").type), "outs": pa.array(outs, kinds.field("outs").type),
        "_seq": lists("_seq", cut - starts, rb.column(seq).filter(head)), "_t": lists("_t", cut - starts, rb.column("_t").filter(head)),
        "_rise": lists("_rise", cut - starts, pa.array(r.rise).filter(head)), "_falls": pa.array(some),
        "_at": lists("_at", later, rb.column(seq).take(pa.array(at))), "_fired": lists("_fired", later, pa.array(fired)),
    }
    return pa.RecordBatch.from_arrays([made[c] for c in kinds.names], kinds.names)


@dataclass(frozen=True)
class RiseAlarm:
    """Alarm when a key's temperature keeps rising for ``interval`` seconds of event time, as a keyed operator.

    Per key, in arrival order, with state ``last`` (starts at ``initial_last``) and a timer:
    a row whose ``ts`` is past the armed fire time first fires the alarm; then a rise with no timer
    arms ``ts + interval``; a fall with a timer cancels it; equal does nothing; ``last`` := temperature.
    At the end of the input a timer fires when its time is <= the largest ``ts`` of the whole input (:meth:`at_end`).

    One plan for every input, in which the records are shuffled once. Each (key, block) has one row for its last reading; a
    prefix over these gives the reading before each block, which goes to the block's records as one more row, so
    that whether a record rises or falls is known there. After the first fall of a block nothing of the timer before it is
    left: those alarms are given at once. What is left is a row for each block, with its records up to that fall (all, if
    there is none) and the block as a function of the timer at its beginning (:class:`TimerMap`). The functions are composed in
    super-blocks and followed over these and inside them, where the records up to the fall are replayed from the timer they begin
    with. No call sees more than ``rows`` records of a key, or the rows of ``RISE_SUPER`` blocks. State per key: ``last``,
    ``fire`` (the armed time) and ``top``, its largest time."""

    interval: int = 10
    key: str = "id"
    field: str = "temperature"
    ts: str = "timestamp"
    seq: str = "seq"
    initial_last: float = RISE_INITIAL_LAST
    rows: int = RISE_ROWS

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,)

    def _message(self):
        return F.concat(F.lit(RISE_MESSAGE_PARTS[0]), F.coalesce(F.col(self.key).cast("string"), F.lit("null")), F.lit(RISE_MESSAGE_PARTS[1]),
                        F.lit(str(self.interval)), F.lit(RISE_MESSAGE_PARTS[2])).alias("message")

    def both(self, df: DataFrame, base: DataFrame | None = None, block: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
        """(alarms ``(key, seq, fire_ts, message)`` with the seq of the record that fired them, states of the keys of ``df``)."""
        key, seq, interval = self.key, self.seq, self.interval
        kind, number = (df.schema[c].dataType.simpleString() for c in (key, seq))
        rows = with_block(df.select(key, seq, F.col(self.ts).alias("_t"), F.col(self.field).alias("_v")), seq, min(block, self.rows))
        ends = rows.groupBy(key, BLK).agg(F.max_by("_v", seq).alias("_last"), F.max("_t").alias("_top"))
        ends = materialize(ends.withColumnRenamed(BLK, "_b"), "rise-ends")
        seen = None if base is None else base.select(key, F.col("last").alias("_prev"), F.lit(1).cast("long").alias("_n"), F.lit(1).cast("long").alias("_rows"))
        before = keyed_running(ends, [key], {"_prev": ("last", F.col("_last")), "_n": ("count", F.lit(1))}, "_b", inclusive=False, block=RISE_SUPER, base=seen)
        last = F.when(F.coalesce(F.col("_n"), F.lit(0)) == 0, F.lit(self.initial_last)).otherwise(F.col("_prev"))
        before = before.select(key, F.lit(None).cast(number).alias(seq), F.lit(None).cast("long").alias("_t"), last.alias("_v"), F.col("_b").alias(BLK), F.lit(0).alias("_own"))

        # as many tasks as there are partitions: the rows are few bytes, but each costs Python time
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sort = [key, BLK, "_own", seq]
        both = rows.withColumn("_own", F.lit(1)).unionByName(before).repartition(parts, key, BLK).sortWithinPartitions(*sort)
        prev = F.lag("_v").over(Window.partitionBy(key, BLK).orderBy("_own", seq))
        both = both.withColumn("_p", prev).where("_own = 1").select(
            key, BLK, seq, "_t", java_lt(F.col("_p"), F.col("_v")).alias("_rise"), java_lt(F.col("_v"), F.col("_p")).alias("_fall"))
        schema = f"{key} {kind}, {BLK} long, {_MAP_SQL}, _seq array<{number}>, _t array<long>, _rise array<boolean>, _falls boolean, _at array<{number}>, _fired array<long>"
        kinds = to_arrow_schema(StructType.fromDDL(schema))

        def first_looks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb, starts in whole_groups(batches, [key, BLK]):
                yield _first_look(rb, starts, key, seq, interval, kinds)

        maps = both.mapInArrow(first_looks, schema)
        maps = materialize(maps.withColumn(SUP, F.floor(F.col(BLK) / RISE_SUPER).cast("long")), "rise-maps")

        def composed(c: dict[str, list]) -> list[tuple]:
            whole, *rest = _maps(c)
            for m in rest:
                whole = whole.then(m)
            return [(whole.always, whole.idle, whole.bounds, whole.outs)]

        def followed(c: dict[str, list]) -> list[tuple]:
            """The timer before and after each super-block."""
            fire, out = c["_seed"][0], []
            for sup, m in zip(c[SUP], _maps(c)):
                out.append((sup, fire, m(fire)))
                fire = out[-1][2]
            return out

        tops = each_group(maps.select(key, SUP, BLK, *_MAP).repartition(parts, key, SUP).sortWithinPartitions(key, SUP, BLK), [key, SUP], composed,
                          f"{key} {kind}, {SUP} long, {_MAP_SQL}")
        seed = None if base is None else base.select(key, F.col("fire").alias("_seed"))
        tops = tops.withColumn("_seed", F.lit(None).cast("long")) if seed is None else join_null_safe(tops, seed, [key], "left")
        tops = materialize(each_group(tops.repartition(parts, key).sortWithinPartitions(key, SUP), [key], followed,
                                      f"{key} {kind}, {SUP} long, _fire long, _left long"), "rise-tops")
        inside = join_null_safe(maps.drop("_at", "_fired"), tops.select(key, SUP, F.col("_fire").alias("_seed")), [key, SUP])

        def heads(c: dict[str, list]) -> list[tuple]:
            """The alarms up to each block's first fall."""
            fire, out = c["_seed"][0], []
            for m, at, t, rise, falls in zip(_maps(c), c["_seq"], c["_t"], c["_rise"], c["_falls"]):
                fall = [False] * len(t)
                fall[-1] = falls
                out += [(at[i], f) for i, f in replay(t, rise, fall, interval, fire)[0]]
                fire = m(fire)
            return out

        out = each_group(inside.repartition(parts, key, SUP).sortWithinPartitions(key, SUP, BLK), [key, SUP], heads,
                         f"{key} {kind}, {SUP} long, {seq} {number}, fire_ts long").select(key, seq, "fire_ts")
        later = maps.where(F.size("_at") > 0).select(key, F.explode(F.arrays_zip("_at", "_fired")).alias("_a"))
        out = out.unionByName(later.select(key, F.col("_a._at").alias(seq), F.col("_a._fired").alias("fire_ts")))
        state = ends.groupBy(key).agg(F.max_by("_last", "_b").alias("last"), F.max("_top").alias("top"))
        state = join_null_safe(state, tops.groupBy(key).agg(F.max_by("_left", SUP).alias("fire")), [key]).select(key, "last", "fire", "top")
        if base is not None:
            old = base.select(key, F.col("top").alias("_top"))
            state = join_null_safe(state, old, [key], "left").select(key, "last", "fire", F.greatest("top", "_top").alias("top"))
        return out.select(key, seq, "fire_ts", self._message()), state

    def run(self, df: DataFrame, base: DataFrame | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
        return self.both(df, base, block)[0]

    def totals(self, df: DataFrame, base: DataFrame | None = None) -> DataFrame:
        return self.both(df, base)[1]

    def at_end(self, totals: DataFrame) -> DataFrame:
        """The alarms of timers that the end of the input fires (seq null)."""
        top = totals.agg(F.max("top")).scalar()
        return totals.where(F.col("fire") <= top).select(self.key, F.lit(None).cast("long").alias(self.seq), F.col("fire").alias("fire_ts"), self._message())


def rise_alarm(df: DataFrame, interval: int = 10, key: str = "id", field: str = "temperature", ts: str = "timestamp", seq: str = "seq",
               initial_last: float = RISE_INITIAL_LAST, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id, fire_ts, message)``: see :class:`RiseAlarm`."""
    op = RiseAlarm(interval, key, field, ts, seq, initial_last)
    out, state = op.both(df, block=block)
    return out.drop(seq).unionByName(op.at_end(materialize(state, "rise-state")).drop(seq))
