"""Connected components of a graph given as links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import forget, kept


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to (node, root), root being the smallest node reachable.

    Alternating stars: each round ties every neighbour of a node to the smallest one, first
    upwards, then downwards; rounds grow with the logarithm of the nodes.  Every round is
    written to the shared folder, so plans stay short.  Only two numbers per round reach the driver.
    """
    edges = kept(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").select(
            F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        )
        following = kept(down.where("u <> v").distinct())
        forget(edges)
        edges, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v"), F.col("v")).distinct())


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
