"""Splitting and combining streams: tag-based split/select, connect + co-map, union, side outputs.

A split never runs the source twice: rows get a tag column in one pass; selecting a tag is a filter
on it, and writing several tags goes through one ``foreachBatch`` over the persisted micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempest.functions.java import java_gt

# Split tags, co-map status texts, side-output tags.
HIGH, LOW = "high", "low"
HIGH_STATUS, NORMAL_STATUS = "high temp warning", "normal"
MAIN_TAG, LOW_TEMP_TAG = "main", "lowTemp"


def split_by_threshold(df: DataFrame, threshold: float = 30.0, field: str = "temperature", tag: str = "tag") -> DataFrame:
    """``split(r -> temp > threshold ? "high" : "low")``: one tag per row (exactly ``threshold`` is low;
    a null or NaN temperature is low, as the JDK comparison is false)."""
    return df.withColumn(tag, F.when(java_gt(field, threshold), F.lit(HIGH)).otherwise(F.lit(LOW)))


def select_tags(tagged: DataFrame, *tags: str, tag: str = "tag", drop_tag: bool = True) -> DataFrame:
    """``splitStream.select(tags...)``."""
    out = tagged.where(F.col(tag).isin(*tags))
    return out.drop(tag) if drop_tag else out


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """``union`` of same-typed streams; duplicates are kept (``UNION ALL``)."""
    out = first
    for o in others:
        out = out.unionByName(o)
    return out


def connect_map(left: DataFrame, right: DataFrame, map_left: Callable[[DataFrame], DataFrame],
                map_right: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``left.connect(right).map(map1, map2)``: each side is mapped on its own and the results are
    unioned by name, missing columns as nulls. No key, no pairing: it is not a join."""
    return map_left(left).unionByName(map_right(right), allowMissingColumns=True)


def warning_status(high: DataFrame, low: DataFrame, status: str = HIGH_STATUS, keep: Sequence[str] = ()) -> DataFrame:
    """The reference's co-map: high → ``(id, temperature, status)``, low → ``(id, "normal")``."""
    return connect_map(
        high, low,
        lambda d: d.select(*keep, "id", "temperature", F.lit(status).alias("status")),
        lambda d: d.select(*keep, "id", F.lit(NORMAL_STATUS).alias("status")),
    ).select(*keep, "id", "temperature", "status")


def tag_side_output(df: DataFrame, main_when: Column, side_tag: str = LOW_TEMP_TAG, tag: str = "tag") -> DataFrame:
    """``ProcessFunction`` with ``ctx.output(sideTag, r)``: rows meeting ``main_when`` are tagged
    ``main``, the others ``side_tag`` (a null condition counts as false)."""
    return df.withColumn(tag, F.when(F.coalesce(main_when, F.lit(False)), F.lit(MAIN_TAG)).otherwise(F.lit(side_tag)))


def write_tagged(tagged: DataFrame, writers: Mapping[str, Callable[[DataFrame], None]], tag: str = "tag") -> None:
    """Write each tag's rows with its own writer, computing the input once (batch, or inside
    ``foreachBatch`` for a stream: ``stream.writeStream.foreachBatch(lambda b, _: write_tagged(b, writers))``)."""
    cached = tagged.persist()
    try:
        for t, write in writers.items():
            write(cached.where(F.col(tag) == F.lit(t)).drop(tag))
    finally:
        cached.unpersist()


def side_outputs_stream(tagged_stream: DataFrame, writers: Mapping[str, Callable[[DataFrame, int], None]], checkpoint: str,
                        tag: str = "tag", available_now: bool = False):
    """Streaming side outputs: one query over the source, each micro-batch split by tag into its own
    sink. A writer takes (rows, batch id) and must address what it writes by the batch, so that a replayed batch replaces its
    first attempt: ``sinks.files.batch_folder``, ``sinks.upserts.write_jdbc_upsert`` with ``batch_id``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_tagged(batch, {t: (lambda rows, w=w: w(rows, batch_id)) for t, w in writers.items()}, tag)

    w = tagged_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
