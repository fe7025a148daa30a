"""CSV file table sink (``insertInto(outputTable)`` with a declared (id, temperature) schema)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def to_output_table(df: DataFrame, names: Sequence[str] = ("id", "temperature")) -> DataFrame:
    """Positional mapping onto the sink schema (``temp`` → ``temperature``), as an insert does."""
    if len(df.columns) != len(names):
        raise ValueError(f"sink expects {len(names)} columns, query has {len(df.columns)}")
    return df.toDF(*names)


def write_csv_table(df: DataFrame, path: str, names: Sequence[str] = ("id", "temperature"), mode: str = "append") -> None:
    to_output_table(df, names).write.mode(mode).csv(path)


def stream_csv_table(stream: DataFrame, path: str, checkpoint: str, names: Sequence[str] = ("id", "temperature")):
    """Append-only CSV sink for a stream; an updating (aggregated) query is refused by Spark, as by the reference."""
    return (to_output_table(stream, names).writeStream.format("csv").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


def batch_folder(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer of micro-batches into ``path``, each into a folder of its own: a replayed batch replaces its first attempt."""
    return lambda rows, batch_id: rows.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")
