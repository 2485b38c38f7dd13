"""Connected components of a link table by alternating large and small stars, every round stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Self-links, repeated links and either direction are allowed. Rounds grow with the logarithm of a component's diameter; each one
    is a few grouped minima and equi-joins, nothing reaches the driver but two numbers.
    """
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    edges = materialise(edges.distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
