"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.cuts import cut

#: Pairs of longs that may be broadcast: 1.6 MB.
HUBS = 100_000


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the links (a, b); the root is the component's smallest node.

    In a round each node hands its larger neighbours to its smallest neighbour, then its smaller
    ones. The smallest neighbour is found by an aggregate, which combines before its shuffle, and handed back to the links of
    its node: those of hubs, nodes of so many links that there can be only ``HUBS``, by a broadcast table, and
    those of all others by a join, so no task reads a hub. Rounds grow with the logarithm of a component's size.
    """
    a_to_b = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = cut(a_to_b.where("u != v").distinct(), "links")
    state = _fingerprint(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = _with_least(both, F.least("u", "m")).where("v > u")
        edges = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = cut(edges, "large-star")
        met = _with_least(edges, F.col("m"))
        # a link to the smallest neighbour stays, the others go to the smallest
        source = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        edges = cut(met.select(source.alias("u"), F.col("m").alias("v")).distinct(), "small-star")
        before, state = state, _fingerprint(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"links have not settled after {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _with_least(links: DataFrame, least: Column) -> DataFrame:
    """The links (u, v) with ``m``, made of the smallest neighbour ``m`` of their ``u``."""
    nodes = cut(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "neighbours")
    nodes = nodes.select("u", least.alias("m"), "n")
    # at most HUBS nodes can have more links than this
    often = (nodes.agg(F.sum("n")).first()[0] or 0) // HUBS + 1
    hubs = F.broadcast(nodes.where(F.col("n") > often).select("u", "m"))
    others = nodes.where(F.col("n") <= often).select("u", "m")
    spread = links.join(hubs.select("u"), "u", "left_anti").join(others, "u")
    return spread.unionByName(links.join(hubs, "u"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)
