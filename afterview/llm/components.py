"""Connected components of a graph whose edges never meet in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step that hangs each vertex's neighbours on the least of them.

    edges: (u, v) with u > v. The large step looks from each vertex to its
    greater neighbours, the small one to its lesser ones; both keep the
    components. Minima are combined before the shuffle, so a hub costs no more
    than its edges.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        new = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a vertex without greater neighbours still hangs on its least one: its own row comes from that one
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        new = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def components(edges: DataFrame, name: str, most: int = 50) -> DataFrame:
    """(node, label) of every node with an edge; label is the least node of its component.

    Large and small star steps in turn, each pair written to the shared folder,
    until nothing changes: then every component is a star around its least
    node. The number of steps grows with the logarithm of the longest path.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name)
    seen = None
    for _ in range(most):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not mark[0] or mark == seen:
            break
        seen = mark
        now = stored(_stars(_stars(now, True), False), name)
    else:
        raise RuntimeError(f"components did not settle in {most} steps")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
