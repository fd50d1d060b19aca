"""Connected components of an edge list, by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every end of an edge (x, y); component_id is its least member.

    Large-star and small-star rounds: every vertex hands its least neighbour to
    its other neighbours, until each edge leads to the least member. The number
    of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder, which cuts the lineage; minima are taken
    within tasks first and joins of a hot vertex are split by AQE.
    """
    now = stage(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).filter("x <> y").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum("y"), F.sum(F.xxhash64("x", "y").cast("decimal(30,0)"))).first()
        if state == before:
            return (
                now.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("doc_id"), F.col("y").alias("component_id"))
                .unionByName(now.select(F.col("y").alias("doc_id"), F.col("y").alias("component_id")).distinct())
            )
        before = state
        now = stage(_small_star(_large_star(now)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a vertex goes to that vertex's least neighbour or itself."""
    both = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    return both.join(least, "x").filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours go to the least of them."""
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    moved = edges.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y")
    return moved.unionByName(least.select("x", F.col("m").alias("y"))).distinct()
