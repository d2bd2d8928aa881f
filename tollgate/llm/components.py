"""Connected components by alternating star contraction.

Every step is a grouped minimum and a join, so a node with very many neighbours is added up before the shuffle
and its rows can be split; no neighbour list is gathered. The steps need a number of
rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Neighbours move to the smallest node around: those above it (large star) or those below (small star).

    ``edges`` has pairs u > v, each once.
    """
    if large:
        around = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = around.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select("v", "m").where("v <> m").toDF("u", "v").unionAll(least.toDF("u", "v"))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of every node in ``edges`` (columns a, b) but
    the smallest ones themselves. Nodes are bigints; edges of a node to itself and repeated ones are allowed.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        after = stored(_star(_star(now, True), False), "edges")
        facts = [f.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for f in (now, after)]
        now = after
        if facts[0] == facts[1]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
