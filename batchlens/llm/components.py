"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.tables import written


def _lowest(edges: DataFrame) -> DataFrame:
    """Per node the lowest of itself and its neighbours."""
    return edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select(
        "c", F.least("c", "m").alias("m")
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every higher neighbour of a node is linked to the lowest one."""
    both = _both_ways(edges)
    joined = both.join(_lowest(both), both["u"] == F.col("c"))
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are linked to the lowest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_lowest(down), down["u"] == F.col("c"))
    lower = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return lower.unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link in ``links(u, v)``; ``root`` is
    the lowest node of its component.

    Rounds of large and small stars, a logarithm of the component's width in
    number; a round shuffles the links, whose number never grows, and a node with
    very many links is only ever aggregated or on the side of a join that can be
    split. Links to NULL and of a node to itself are ignored.
    """
    tidy = lambda e: e.where(F.col("u") != F.col("v")).distinct()
    edges = written(tidy(links.select("u", "v")), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = written(tidy(_small_star(tidy(_large_star(edges)))), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
