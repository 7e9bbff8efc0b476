"""Connected components by alternating large-star and small-star steps, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import stored

#: Rounds after which something is wrong: the steps settle in O(log^2 n) rounds.
MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each neighbour above u is tied to the least node of u's neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """u and its lower neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node that a link between two different nodes names; root is the least node.

    A node's links are never gathered: minima combine before the shuffle, and the joins on a node are
    plain equi joins that adaptive execution splits when one node has very many links. Every round is
    written to the shared folder, so that a lost executor costs no earlier round. Links with a null end
    and loops are ignored; repeated links count once; no links give no rows.
    """
    first = (links.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col("u").isNotNull()).where("u > v").distinct())
    edges = stored(first, "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = stored(_small(_large(edges)), "stars")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
