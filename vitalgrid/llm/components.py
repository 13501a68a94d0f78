"""Connected components of an edge table, by alternating large and small stars.

Each round is a few joins and aggregations; its edges are written to the shared folder. Nodes with
many edges are only ever a skewed side of a join, which Spark splits, or are reduced by a partial
minimum. Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.session import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) whose root, the smallest node of its component,
    is another node. Edges may repeat, point either way or to themselves."""
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = materialize(edges.select(larger, smaller).where("u > v").distinct(), "links")
    state = _state(stars)
    while state[0]:
        both = stars.select("u", "v").union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v")
        )
        # A node whose neighbours are all smaller keeps the link to the smallest.
        large = large.union(least.where("u > m").select("u", "m")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(small.union(root).distinct(), "links")
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
