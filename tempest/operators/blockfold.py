"""Sequential Python per key in parallel blocks.

A function that must see a key's records one after the other (a user's reduce, a timer machine) would put a hot key
into one task. Here the arrival sequence is cut into blocks as in ``tempest.operators.scan``, each (key, block) is
run on its own from rows that arrive sorted in Arrow batches (:func:`each_block`), and the blocks' results are
combined by a prefix over them, which runs the same way one level up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tempest.operators.scan import BLK, SUP, join_null_safe, with_block
from tempest.session import materialize

#: Records of a block: the most that one call sees.
ROWS = 1 << 16
#: Blocks of a super-block.
SUPER = 1 << 10


def group_starts(batches: Iterator[pa.RecordBatch], group: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches with rows, sorted by ``group``, and which of their rows begin a group."""
    last = None
    for rb in batches:
        if not rb.num_rows:
            continue
        new = np.zeros(rb.num_rows, bool)
        for c in group:
            x = rb.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        new[0] = last is None or any(last.column(c)[0].as_py() != rb.column(c)[0].as_py() for c in group)
        yield rb, new
        last = rb.slice(rb.num_rows - 1)


def whole_groups(batches: Iterator[pa.RecordBatch], group: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of batches sorted by ``group``, cut anew where a group ends, and the places at which groups begin."""
    held: list[pa.RecordBatch] = []  # the last group so far
    for rb, new in group_starts(batches, group):
        cuts = np.flatnonzero(new)
        if len(cuts) and (held or cuts[-1] > 0):
            n = sum(x.num_rows for x in held)
            yield pa.concat_batches([*held, rb.slice(0, cuts[-1])]), np.concatenate([[0] if n else [], n + cuts[:-1]]).astype(np.int64)
            held = []
        held.append(rb.slice(cuts[-1]) if len(cuts) else rb)
    if held:
        yield pa.concat_batches(held), np.zeros(1, np.int64)


def each_block(df: DataFrame, group: Sequence[str], order: str, run: Callable[[pa.Table], pa.Table], schema: str | StructType) -> DataFrame:
    """``run`` on the rows of each ``group``, sorted by ``order``. Many small groups come in one Arrow batch, so a
    group costs a slice of it; a group over several batches is held until its end."""
    d = df.repartition(*group).sortWithinPartitions(*group, order)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for rb, new in group_starts(batches, group):
            cuts = np.append(np.flatnonzero(new), rb.num_rows)
            if cuts[0] > 0:  # the held group goes on
                held.append(rb.slice(0, cuts[0]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held:
                    yield from run(pa.Table.from_batches(held).combine_chunks()).to_batches()
                held = [rb.slice(a, b - a)]
        if held:
            yield from run(pa.Table.from_batches(held).combine_chunks()).to_batches()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for rb in parts(batches):
            some.append(rb)
            n += rb.num_rows
            if n >= 10_000:
                yield from pa.Table.from_batches(some).combine_chunks().to_batches()
                some, n = [], 0
        if some:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()

    return d.mapInArrow(packed, schema)


def each_group(df: DataFrame, group: Sequence[str], run: Callable[[dict[str, list]], list[tuple]], schema: str) -> DataFrame:
    """``run`` on each ``group`` of ``df``, which must come partitioned by it and sorted: it gets the columns as Python lists and
    gives its rows, without the group columns, which come first in ``schema``. Columns are turned into lists, and rows into
    Arrow, a batch at a time, so that a group of a few records costs little more than the call."""
    group = list(group)
    columns = [c for c in df.columns if c not in group]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, dict[str, list], bool]]:
        """(key, columns) of each whole group, and whether a batch has ended with it."""
        key, held = None, None
        for rb, new in group_starts(batches, group):
            cuts = [*np.flatnonzero(new).tolist(), rb.num_rows]
            lists = {c: rb.column(c).to_pylist() for c in columns}
            if cuts[0] > 0:  # the held group goes on
                for c in columns:
                    held[c] += lists[c][: cuts[0]]
            keys = list(zip(*(rb.column(c).take(pa.array(cuts[:-1], pa.int64())).to_pylist() for c in group)))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if held is not None:
                    yield key, held, i == 0
                key, held = keys[i], {c: lists[c][a:b] for c in columns}
        if held is not None:
            yield key, held, True

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for key, held, ended in parts(batches):
            rows += [(*key, *r) for r in run(held)]
            if rows and (ended or len(rows) >= 10_000):
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), kinds)], kinds.names)

    return df.mapInArrow(answers, schema)


Reduce = Callable[[dict, dict], dict]


def _either(fn: Reduce, a: dict | None, b: dict | None) -> dict | None:
    return b if a is None else a if b is None else fn(a, b)


@dataclass(frozen=True)
class UserReduce:
    """Rolling ``reduce(fn)`` with any associative Python function ``fn(earlier: dict, later: dict) -> dict`` of records
    with ``fields``; the first record of a key is its own result (A4 with a user function). One result per record, in arrival
    order: ``(key, seq, *fields)``. Null fields reach ``fn`` as None.

    A parallel scan: blocks are reduced from their own first record, the blocks' results get a prefix in super-blocks
    and over them, and a second pass reduces each record's result onto what came before its block. State per key (for
    ``folds.run_keyed``): ``acc``, the result so far."""

    fn: Reduce
    fields: tuple[str, ...]
    key: str = "id"
    seq: str = "seq"
    rows: int = ROWS

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,)

    def _acc(self, df: DataFrame):
        return F.struct(*[F.col(c) for c in self.fields]).alias("acc")

    def _scan(self, df: DataFrame, group: list[str], order: str, before: bool = True) -> DataFrame:
        """``df`` (group, order, acc) with ``inc``, the reduction of acc up to and with the row in its group, ``exc``, that
        before the row (null at first; with ``before``), and ``_end`` at the last row."""
        fn = self.fn
        accs = [F.col("acc").alias("inc"), *([F.col("acc").alias("exc")] if before else [])]
        schema = StructType([*[df.schema[c] for c in (*group, order)], *df.select(*accs, F.lit(True).alias("_end")).schema])
        schema = StructType([StructField(f.name, f.dataType, True) for f in schema])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # an Arrow batch at a time, whatever the number of its groups: a group goes on from ``now``
            now, held = None, None  # held: the batch before, whose last row may be its group's last
            for rb, new in group_starts(batches, group):
                if held is not None:
                    yield ended(*held, bool(new[0]))
                inc, exc = [], []
                for rec, first in zip(rb.column("acc").to_pylist(), new.tolist()):
                    now = None if first else now
                    exc.append(now)
                    now = _either(fn, now, rec)
                    inc.append(now)
                kind = rb.column("acc").type
                accs = [pa.array(inc, kind), pa.array(exc, kind)][: 1 + before]
                held = [*[rb.column(c) for c in (*group, order)], *accs], new
            if held is not None:
                yield ended(*held, True)

        def ended(columns: list[pa.Array], new: np.ndarray, last: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.append(new[1:], last))], schema.names)

        d = df.select(*group, order, "acc").repartition(*group).sortWithinPartitions(*group, order)
        return d.mapInArrow(run, schema)

    def _merged(self, df: DataFrame, earlier: str, later: str, name: str) -> DataFrame:
        """``df`` with ``name`` = fn(earlier, later), or the one that is not null."""
        fn = self.fn
        schema = StructType([*[f for f in df.schema if f.name not in (earlier, later)], *df.select(F.col(later).alias(name)).schema])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                a, b = rb.column(earlier), rb.column(later)
                has_a, has_b = (x.is_valid().to_numpy(zero_copy_only=False) for x in (a, b))
                both = np.flatnonzero(has_a & has_b)  # only these go through Python
                made = pa.array([fn(x, y) for x, y in zip(a.take(pa.array(both)).to_pylist(), b.take(pa.array(both)).to_pylist())], b.type)
                at = np.where(has_b, rb.num_rows, 0) + np.arange(rb.num_rows)
                at[both] = 2 * rb.num_rows + np.arange(len(both))
                out = pa.concat_arrays([a if a.type == b.type else pa.array(a.to_pylist(), b.type), b, made]).take(pa.array(at))
                keep = [f.name for f in schema][:-1]
                yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in keep], out], [*keep, name])

        return df.mapInArrow(run, schema)

    def both(self, df: DataFrame, base: DataFrame | None = None, block: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(results per record, states of the keys of ``df``)."""
        block = min(block or self.rows, self.rows)
        rows = with_block(df.select(self.key, self.seq, self._acc(df)), self.seq, block)
        r = materialize(self._scan(rows, [self.key, BLK], self.seq, before=False), "reduced")
        ends = r.where("_end").select(self.key, BLK, F.col("inc").alias("acc"), F.floor(F.col(BLK) / SUPER).cast("long").alias(SUP))
        in_super = materialize(self._scan(ends, [self.key, SUP], BLK), "reduced-blocks")
        tops = self._scan(in_super.where("_end").select(self.key, SUP, F.col("inc").alias("acc")), [self.key], SUP)  # a row per 2^26 records
        tops = materialize(tops, "reduced-tops")
        before = tops.select(self.key, SUP, F.col("exc").alias("top"))
        final = tops.where("_end").select(self.key, F.col("inc").alias("later"))
        if base is not None:
            seed = base.select(self.key, F.col("acc").alias("seed"))
            before = self._merged(join_null_safe(before, seed, self.keys, "left"), "seed", "top", "top")
            final = join_null_safe(final, seed, self.keys, "left")
        else:
            final = final.withColumn("seed", F.lit(None).cast(final.schema["later"].dataType))
        carry = join_null_safe(in_super.select(self.key, SUP, BLK, "exc"), before, [self.key, SUP])
        carry = self._merged(carry, "top", "exc", "carry").drop(SUP)
        out = self._merged(join_null_safe(r.select(self.key, BLK, self.seq, "inc"), carry, [self.key, BLK]), "carry", "inc", "acc")
        return out.select(self.key, self.seq, "acc.*"), self._merged(final, "seed", "later", "acc").select(self.key, "acc")

    def run(self, df: DataFrame, base: DataFrame | None = None, block: int | None = None) -> DataFrame:
        return self.both(df, base, block)[0]

    def totals(self, df: DataFrame, base: DataFrame | None = None) -> DataFrame:
        return self.both(df, base)[1]
