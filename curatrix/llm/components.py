"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _small_neighbours(edges: DataFrame) -> DataFrame:
    """For each node the least of itself and its neighbours."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; ``root`` is the least node of its component.

    Alternates two steps until nothing changes: every node links its greater
    neighbours to its least one, then itself and its smaller neighbours.  Rows
    never exceed the number of edges, hubs are aggregated before they are
    shuffled, and each round is written to the shared folder, which cuts its
    lineage.  Loops and repeated edges do no harm.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_small_neighbours(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        least = _small_neighbours(large)
        small = large.join(least, "a")
        now = materialise(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).where("a > b").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
