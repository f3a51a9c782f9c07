"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import workspace


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours on the least node around: of each node, its larger (or smaller) ones."""
    both = edges if small else edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    least = least.withColumn("least", F.least("least", "high"))
    joined = both.join(least, "high")
    if small:
        # a node and its smaller neighbours go under the least of them
        hung = joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
        hung = hung.unionByName(least.select("high", F.col("least").alias("low")))
    else:
        hung = joined.where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        hung = hung.unionByName(least.select("high", F.col("least").alias("low")))
    return hung.where("high > low").distinct()


def least_reachable(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root): every node that has a link, and the least node it reaches.

    Each round is a table in the shared folder, so lineage stays short. Rounds
    grow with the logarithm of the longest path. A node with very many links is
    a skewed key of an inner join, which adaptive execution splits.
    """
    edges = (
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high > low").distinct()
    )
    edges = workspace.materialize(edges, "links")
    state = None
    while True:
        edges = workspace.materialize(_star(_star(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return nodes.unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
