"""Connected components by alternating star contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starblend.workspace import Workspace


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node itself, point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the least neighbour, the node itself included."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b`` long); the root is the least node and not listed itself.

    Every round is written to the shared folder and reread, so no lineage grows with the rounds.  A hot node
    is summed on the map side; the join back is an ordinary shuffled join that Spark may split.
    """
    now = work.table(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while True:
        now = work.table(_small_star(_large_star(now)), "stars")
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if tuple(state) == seen or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
