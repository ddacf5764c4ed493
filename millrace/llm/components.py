"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, release


def _toward_least(edges: DataFrame) -> DataFrame:
    """Link every node that is larger than u to the least of u and its neighbours; ``edges`` go from larger to smaller."""
    up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = edges.unionByName(up).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return up.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _down(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(others)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the least node reachable.

    Alternates two star contractions until nothing changes. Each is written to the shared folder,
    so that plans, which the driver keeps, stay those of one. Neighbours are never gathered: a node
    only needs their least one.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = materialise(now, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        half = materialise(_toward_least(now), "stars")
        past, now = now, materialise(_down(half).distinct(), "edges")
        release(past, half)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
