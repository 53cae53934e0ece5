"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import written


def _smallest(links: DataFrame) -> DataFrame:
    """Links with the smallest node next to their first node, itself included."""
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    return links.join(least.select(F.col("a").alias("_a"), "_m"), F.col("a") == F.col("_a")).select(
        "a", "b", F.least("a", "_m").alias("m")
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _smallest(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = _smallest(down)
    moved = found.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(found.select("a", F.col("m").alias("b")))


def _stars(links: DataFrame) -> bool:
    """Whether every link goes from a node that has no other to a smaller one that has none down."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("root"), (F.col("a") < F.col("b")).alias("up"))
    ends = ends.unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("root"), F.lit(False).alias("up")))
    nodes = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("root").alias("root"), F.max("up").alias("up"))
    return nodes.filter((F.col("down") + F.col("root") > 1) | F.col("up")).isEmpty()


def components(links: DataFrame, name: str) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in the links ``a``, ``b``.

    Large-star and small-star steps in turn move every node towards the smallest one it can
    see, until all components are stars. Each round is written, so its lineage is cut and a
    lost executor costs one round at most. Joins on nodes with many links are left to the
    engine's skew handling; minima are combined before the shuffle.
    """
    now = written(links.select("a", "b").filter("a <> b").distinct(), f"{name}-links")
    while not _stars(now):
        now = written(_small_star(_large_star(now)).filter("a <> b").distinct(), f"{name}-links")
    leaves = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
