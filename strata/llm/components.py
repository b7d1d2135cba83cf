"""Connected components of an edge table, by alternating star rounds.

Large-star links every larger neighbour of a node to the smallest node of its
neighbourhood; small-star does so for the smaller neighbours. When a round
changes nothing, every component is a star around its smallest node. Both are
an aggregate (with a map-side step, so a hub costs a row per task) and a join
on the node, whose skewed partitions Spark splits. Each round is written to
the shared folder; the driver sees one summary row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b), any direction; the result has a > b."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    if large:
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.where("v > u").join(low, "u")
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        down = both.where("v < u")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        out = (joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
               .union(low.select("u", "m")))
    return out.where("a <> b").distinct()


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of longs -> (node, root): root is the smallest node reached.

    Nodes without an edge to another node do not appear. NULL ends are
    ignored, repeated edges and self-loops change nothing.
    """
    clean = (edges.toDF("a", "b").where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = materialise(clean, "star")
    before = _summary(now)
    while before[0]:
        now = materialise(_star(_star(now, large=True), large=False), "star")
        after = _summary(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct())
