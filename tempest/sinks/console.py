"""Console output with a label (``print("label")``): for looking at a stream while developing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def print_stream(stream: DataFrame, label: str | None = None, *, rows: int, available_now: bool = False):
    """Start a console sink that prints up to ``rows`` rows of every micro-batch, each prefixed by ``label``. The
    number is the caller's choice: printing is for looking at a stream, and takes its rows to the driver."""
    out = stream.select(F.lit(label).alias("label"), "*") if label else stream
    w = out.writeStream.format("console").option("truncate", "false").option("numRows", rows).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w).start()


def print_batch(df: DataFrame, label: str | None = None, *, rows: int) -> None:
    """``show`` a batch DataFrame with a label column (takes ``rows`` rows to the driver, nothing more)."""
    (df.select(F.lit(label).alias("label"), "*") if label else df).show(rows, truncate=False)
