"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, release


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that is not itself the smallest.

    Links are undirected; loops and repeats don't matter. Returns
    ``node, component`` with ``component < node``; nodes that are missing are
    their own component. Every round writes its links to the shared folder and
    removes those of the round before; the loop ends when a round changes nothing.
    """
    edges = cut_lineage(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        release(edges)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]
