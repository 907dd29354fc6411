"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of each node in ``links(a, b)``; a component is named after its least node.

    Large and small stars alternate: each node's larger neighbours are tied to its least one, then its smaller
    neighbours are, until nothing changes. The number of rounds grows with the logarithm of the longest
    chain. A minimum runs before each shuffle; a hot node's neighbours stay apart in the join, which adaptive execution splits.
    Each round is a written table, so that plans stay short and a lost executor costs one round.
    """
    edges = settled(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = settled(star(edges, large=False).transform(lambda e: star(e, large=True)), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    below = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return below.unionByName(roots)


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Links ``a > b`` after one step: from each node's larger (or smaller) neighbours to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    tied = both.join(least, "a")
    if large:
        tied = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return tied.where(F.col("a") != F.col("b")).distinct()


def state(edges: DataFrame) -> tuple:
    """The number of links and a sum over them, which a round that changes anything changes."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
