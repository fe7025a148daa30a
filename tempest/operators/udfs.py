"""User functions: scalar ``hashCode``, table function ``split`` (lateral join), aggregate ``avgTemp``.

Each has a Catalyst-native form used by the queries (stays in codegen, partial aggregation for
``avgTemp``) and a SQL registration so SQL text can call it by name.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.functions.java import java_hash, java_length, java_split


def hash_code(col: str | Column = "id") -> Column:
    """Scalar function ``HashCode.eval(String) = str.hashCode()``."""
    return java_hash(col)


def register_hash_code(spark: SparkSession, name: str = "hashCode") -> None:
    """SQL scalar function (a SQL UDF: inlined by the analyzer, no Python)."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT "
        "RETURN CASE WHEN s IS NULL THEN NULL ELSE CAST(java_method('java.util.Objects', 'hashCode', s) AS INT) END"
    )


def split_table(df: DataFrame, col: str = "id", sep: str = "_", keep: tuple[str, ...] = ("id", "ts")) -> DataFrame:
    """``joinLateral("split(id) as (word, length)")``: one row per piece of ``col`` split on ``sep``
    (JDK split rules), with the piece's length. An inner lateral join: rows with no piece vanish."""
    pieces = F.transform(java_split(col, sep), lambda w: F.struct(w.alias("word"), java_length(w).alias("length")))
    return df.select(*keep, F.inline(pieces))


def split_sql_expr(col: str = "id", sep: str = "_") -> str:
    """SQL text of the same table function, for ``LATERAL VIEW inline(...) t AS word, length``."""
    lit = sep.replace("\\", "\\\\").replace("'", "\\'")
    p = f"split({col}, '{lit}', -1)"
    kept = f"aggregate(transform({p}, (w, i) -> if(w != '', i + 1, 0)), 0, (a, x) -> greatest(a, x))"
    arr = f"CASE WHEN {col} = '' THEN array('') ELSE slice({p}, 1, {kept}) END"
    return f"transform({arr}, w -> named_struct('word', w, 'length', CAST(octet_length(encode(w, 'UTF-16BE')) / 2 AS INT)))"


def register_split_udtf(spark: SparkSession, name: str = "split_words", sep: str = "_") -> None:
    """SQL table function for ``FROM t, LATERAL split_words(id)`` (a SQL function: inlined by the analyzer)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS TABLE (word STRING, length INT) "
              f"RETURN SELECT p.word, p.length FROM (SELECT explode({split_sql_expr('s', sep)}) AS p)")


def avg_temp(col: str | Column = "temp") -> Column:
    """Aggregate function ``AvgTemp`` (accumulator ``(sum, count)``, result ``sum / count``), as a
    Catalyst aggregate so it is partially aggregated before the shuffle."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c) / F.count(c)


def register_avg_temp(spark: SparkSession, name: str = "avgTemp") -> None:
    """SQL name for the aggregate, as a grouped-aggregate pandas UDF. Pandas aggregate UDFs get no
    partial aggregation (every row of a group is shipped), so prefer :func:`avg_temp` in plans."""

    @F.pandas_udf("double")
    def _avg(v: pd.Series) -> float:
        v = v.dropna()
        return float(v.sum() / len(v)) if len(v) else None

    spark.udf.register(name, _avg)
