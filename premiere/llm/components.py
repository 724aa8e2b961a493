"""Connected components of a link table by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import join_spread
from premiere.session import materialise


def _state(edges: DataFrame) -> tuple:
    """Tells whether two link tables are the same: their number and a sum over all of them."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _star(pairs: DataFrame, label: str) -> DataFrame:
    """Pairs (u, v) with m, the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    return join_spread(pairs, materialise(least, label), "u", "n").drop("n")


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that has a link; a component is named by its least node.

    `links` has columns u and v. A large star hangs the greater neighbours of a node below its least
    one, a small star the lesser ones: the number of rounds grows with the logarithm of the longest
    chain, squared at most. Every round is written to the shared folder.
    """
    edges = materialise(links.filter("u != v").selectExpr("greatest(u, v) u", "least(u, v) v").distinct(), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        large = materialise(_star(both, "star").filter("v > u").selectExpr("v AS u", "m AS v").distinct(), "large-star")
        starred = _star(large, "star")
        small = starred.filter("v != m").selectExpr("v AS u", "m AS v").unionByName(starred.selectExpr("u", "m AS v"))
        edges = materialise(small.distinct(), "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
