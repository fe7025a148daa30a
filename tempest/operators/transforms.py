"""Per-record transforms: map, flatMap, filter, projection, and the rich (open/close) map."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.functions.java import java_length, java_split


def line_lengths(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``map(line -> line.length())``."""
    return lines.select(*keep, java_length(value_col).alias("len"))


def line_fields(lines: DataFrame, value_col: str = "value", sep: str = ",", keep: tuple[str, ...] = ()) -> DataFrame:
    """``flatMap(line -> line.split(","))``: one row per field, with its position ``pos`` (from 0)."""
    return lines.select(*keep, F.posexplode(java_split(value_col, sep)).alias("pos", "field"))


def prefix_filter(lines: DataFrame, prefix: str = "sensor_1", value_col: str = "value") -> DataFrame:
    """``filter(line -> line.startsWith(prefix))`` — a prefix test, so ``sensor_1`` also keeps ``sensor_10``."""
    return lines.where(F.col(value_col).startswith(prefix))


def with_task_index(df: DataFrame, key: str = "id", name: str = "subtask") -> DataFrame:
    """``RichMapFunction`` with ``getIndexOfThisSubtask``: ``(id, index of the task that mapped it)``.
    Non-deterministic by nature (depends on the partitioning)."""
    return df.select(key, F.spark_partition_id().alias(name))


def rich_map(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame], schema: str,
             open_fn: Callable[[], object] | None = None, close_fn: Callable[[object], None] | None = None) -> DataFrame:
    """A map with a per-task life cycle: ``open_fn()`` once before the first batch of a task (e.g. open a
    connection), ``fn(batch, resource)`` per Arrow batch, ``close_fn(resource)`` after the last one, even
    on failure. Use it only when ``fn`` is opaque Python; column expressions are faster."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_fn() if open_fn else None
        try:
            for b in batches:
                yield fn(b, resource)
        finally:
            if close_fn:
                close_fn(resource)

    return df.mapInPandas(run, schema)


def map_python(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """``map(MapFunction)`` for an opaque Python function of one record (a dict) → one record.
    Runs in Arrow batches through ``mapInPandas``; prefer Column expressions when they exist."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [f.split()[0] for f in schema.split(",")]
        for b in batches:
            out = [fn(r) for r in b.to_dict("records")]
            if out:  # an empty frame has no usable column types
                yield pd.DataFrame(out, columns=cols)

    return df.mapInPandas(run, schema)


def flat_map_python(df: DataFrame, fn: Callable[[dict], list], schema: str) -> DataFrame:
    """``flatMap(FlatMapFunction)``: each record → zero or more records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [f.split()[0] for f in schema.split(",")]
        for b in batches:
            out = [o for r in b.to_dict("records") for o in fn(r)]
            if out:
                yield pd.DataFrame(out, columns=cols)

    return df.mapInPandas(run, schema)


def filter_python(df: DataFrame, pred: Callable[[dict], bool]) -> DataFrame:
    """``filter(FilterFunction)`` with an opaque Python predicate; keeps the input schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = [bool(pred(r)) for r in b.to_dict("records")]
            yield b[keep]

    return df.mapInPandas(run, df.schema)
