"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import stored
from trustmart.operators.joins import lookup


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("__a"), F.least("a", "m").alias("m"))
    joined = lookup(both.filter("b > a"), least, "a", "__a", "inner")
    return joined.select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    joined = lookup(down, least.withColumnRenamed("b", "__b"), "b", "__b", "inner")
    moved = joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return moved.unionByName(own).filter("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link; a component is its smallest node.

    ``links`` has two bigint columns a and b. Large-star and small-star rounds take turns until
    nothing moves, about log(n) of them; each round is a written table. A node with very many links
    is summed before it is shuffled, and each side of the joins has a shuffle of its own, so that
    adaptive execution can split such a node's links.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)), "star")
        # One row: how many links there are, and a sum over all of them.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
