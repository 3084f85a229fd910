"""Connected components of links, by alternating large and small stars on DataFrames.

A large star moves every larger neighbour of a node to the node's smallest neighbour, a small
star every smaller one; both keep the components, and when nothing moves any more each node
points at the smallest of its component. Rounds grow with the logarithm of the longest chain.
Each round is stored in the shared folder; a hub's rows are spread by the skewed-join rule,
since both sides of its join are stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import stored


def _mark(df: DataFrame) -> tuple:
    row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def stars(links: DataFrame) -> DataFrame:
    """(u, v): each linked node but the smallest of its component, with that smallest node.

    ``links`` has long columns a and b; links of a node with itself or with null are left out.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "stars")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = stored(both.groupBy("x").agg(F.min(F.least("x", "y")).alias("m")), "stars")
        moved = both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        moved = stored(moved, "stars")
        least = stored(moved.groupBy("u").agg(F.min("v").alias("m")), "stars")
        edges = stored(
            moved.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges
