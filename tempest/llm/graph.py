"""Connected components of a distributed edge list (alternating large-star and small-star rounds).

Edges stay in Spark: each round is two aggregations and two joins on the node, written below the checkpoint
folder. Minima are pre-aggregated before the shuffle, so a node with very many neighbours costs a row per task;
the joins bring one row (the minimum) to a node's edges, which adaptive execution may split further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.session import materialize


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) → (node, comp): the smallest node reachable, for every node with an edge."""
    e = materialize(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    while True:
        sym = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sym.join(low, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        e = materialize(small, "small-star")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
