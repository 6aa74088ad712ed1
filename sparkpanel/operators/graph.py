"""Connected parts of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.session import cut_lineage


def connected_parts(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, part): every node of the links with the least node it is connected to.

    In turn, each node points its larger neighbours to the least one it knows, then itself
    and its smaller ones; paths halve, so the rounds grow with the logarithm of the longest.
    Each least value is taken in every task before the shuffle. Null nodes are left out.
    """
    known = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
    alone = known.select(F.col("x").alias("node")).unionByName(known.select(F.col("y").alias("node"))).distinct()
    now = cut_lineage(known.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        up = cut_lineage(both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y").distinct())
        own = up.groupBy("x").agg(F.min("y").alias("m"))
        down = up.join(own, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(own.select("x", F.col("m").alias("y")))
        now = cut_lineage(down.filter("x <> y").distinct())
    return alone.join(now.withColumnsRenamed({"x": "node", "y": "part"}), "node", "left").select("node", F.coalesce("part", "node").alias("part"))
