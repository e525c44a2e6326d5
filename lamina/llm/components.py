"""Connected components by alternating star contraction.

Every round links each node's larger neighbours to the smallest node it knows (large star),
then its smaller neighbours likewise (small star), until nothing changes.  Rounds grow with
the logarithm of the largest component's size; a round is two aggregations, which combine
before the shuffle, and two joins on the node, whose other side has one row for each node,
so that a node with very many neighbours can be split.  Every round is cut in the shared
folder, and only counts come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _io


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame | None:
    """(node, root) of every node with an edge to another; root is the smallest node of the component.  None if there are no edges.

    Nulls and loops are ignored, repeated edges count once.
    """
    u, v = F.col(left), F.col(right)
    both = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u is not null and v is not null and u != v and {0} is not null and {1} is not null".format("u", "v"))
    now = _io.cut(both.distinct())
    if now.isEmpty():
        return None
    mark = None
    for _ in range(max_rounds):
        # Large star: all neighbours, links of larger ones go to the least.
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # Small star: smaller neighbours and the node itself go to the least.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        now = _io.cut(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            roots = now.select(F.col("v").alias("u")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("root")))
        mark = seen
    raise RuntimeError("components: no fixed point")
