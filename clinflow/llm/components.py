"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.operators.storage import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.

    Each round writes its links to the shared folder: lost executors cost a round at most. Minima
    are written before they are joined, so that both sides of a join are plain exchanges and a node
    with very many links is split among tasks. Self links and repeated links do no harm; links with
    a NULL end are no links. An empty table gives an empty table.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(
            both.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")), "minima")
        large = materialize(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(), "large_star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        joined = large.join(least, "u")
        edges = materialize(
            joined.select("u", F.col("m").alias("v"))
            .union(joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())
