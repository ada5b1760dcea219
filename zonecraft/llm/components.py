"""Connected components by alternating large-star and small-star steps; nothing is gathered on the driver.

Each step hangs every neighbour of a node on the smallest node it can see, as grouped minima joined back, so a hub's
edges spread over tasks. Stars are reached in a number of steps that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b); the root is the smallest node of the component."""
    now = stages.write(_downward(edges), "edges")
    seen = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        following = stages.write(small.where("a > b").distinct(), "edges")
        stages.drop(now)
        now, before, seen = following, seen, _state(following)
        if seen == before:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.distinct()


def _state(edges: DataFrame) -> tuple:
    """One row that tells whether a step changed the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
