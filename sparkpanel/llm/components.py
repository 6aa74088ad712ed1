"""Connected components of a table of links, by local union-find and star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.staging import staged

#: Links that one union-find holds at once.
LOCAL = 1_000_000
_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a task: each node that is not least in its set, with the least."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = up = parent.setdefault(up, up)
            x = up
        return x

    def stars():
        nodes = [x for x in parent if parent[x] != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], schema=_SCHEMA)

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > LOCAL:
            yield stars()
            parent = {}
    if parent:
        yield stars()


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in the links (u, v): the smallest id that can be reached.

    Each task first reduces its links to a forest of stars; large and small star steps
    then shorten all paths until nothing changes, which takes a number of rounds that
    grows with the logarithm of the ids. Sums over a frequent id are taken in each task
    first. Links that are null or loops are ignored. No links give no rows.
    """
    clean = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    now, before = staged(clean.mapInArrow(_forest, "u long, v long").distinct(), "links"), None
    while (mark := now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()) != before:
        before = mark
        now = staged(_small_star(staged(_large_star(now), "stars")), "links")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
