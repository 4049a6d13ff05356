"""Connected components of a table of links, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import discard, written


def small_star(edges: DataFrame) -> DataFrame:
    """Links (a, b), a > b: every node's neighbours below it, and the node, go to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest reachable node) of all nodes of links (a, b).

    Alternating large-star and small-star: every node hands its larger neighbours to the smallest neighbour, then its
    smaller ones, until nothing changes. The number of rounds grows with the logarithm of a component's size. Each round
    is written to the shared folder. Hot nodes need one row for each link, split by aggregation before the shuffle.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    first, edges = edges, written(small_star(edges), "links")  # first, as it leaves about one link for each node
    discard(first)
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        last, edges = edges, written(small_star(large), "links")
        discard(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    out = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = out.select("component").distinct()
    return out.select(F.col("a").alias("node"), "component").unionByName(roots.select(F.col("component").alias("node"), "component"))
