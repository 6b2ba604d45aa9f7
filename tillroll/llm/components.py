"""Connected components of a graph as Spark joins: alternating large and small stars.

Each round points every node at the least node it knows, in two steps that keep the components as
they are. Neighbourhoods are never collected: a step takes the minimum per node, which Spark combines
before the shuffle, and joins it back to the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.staging import staged

_MAX_ROUNDS = 50


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    both = both.toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, go to the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.select("high", F.col("least").alias("low"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node of an edge that is not the least of its component.

    Edges to NULL and loops are ignored.
    """
    pairs = edges.select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
    current = staged(pairs.where("high > low").distinct(), "links")
    state = _state(current)
    for _ in range(_MAX_ROUNDS):
        current = staged(_small_star(_large_star(current)), "links")
        before, state = state, _state(current)
        if state == before:
            return current.select(F.col("high").alias("node"), F.col("low").alias("root"))
    raise RuntimeError(f"components did not settle in {_MAX_ROUNDS} rounds")


def _state(edges: DataFrame) -> tuple:
    """A count and a checksum, which do not depend on the order of rows."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first())
