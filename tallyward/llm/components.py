"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import written


#: Edges that make a node a hub, as a share of all edges: at most as many nodes are hubs.
HUB_SHARE = 1000


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Edges (a, b) -> edges to the least neighbour. Large star: every larger
    neighbour of a node is tied to the node's least neighbour; small star: the node
    and its smaller neighbours are. The least neighbour is an aggregate joined back. ``total``: the
    rows by node, or less; nodes with over a HUB_SHARE-th of them are at most HUB_SHARE, so they
    are broadcast, and their edges stay where they are."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    least = least.select("a", F.least("m", "a").alias("m"), "degree")
    is_hub = F.col("degree") * HUB_SHARE > total
    hubs = F.broadcast(least.where(is_hub).select("a", "m"))
    others = both.join(hubs.select("a"), "a", "left_anti").join(least.where(~is_hub).select("a", "m"), "a")
    tied = both.join(hubs, "a").union(others.select("a", "b", "m"))
    if large:
        out = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (a, b): every node that is not its component's least
    one, with that least node. Each round is a written table; the number of rounds
    grows with the logarithm of the longest path."""

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()

    edges = written(edges.where(F.col("a") != F.col("b")), "edges")
    before = state(edges)
    while True:
        # each star is a written table: a plan refers to its edges several times. The large star of n edges has at most n
        edges = written(_star(edges, True, 2 * before[0]), "large-stars")
        edges = written(_star(edges, False, before[0]), "stars")
        after = state(edges)
        if after == before:
            return edges
        before = after
