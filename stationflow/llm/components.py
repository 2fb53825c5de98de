"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to its smallest one."""
    sides = _both_ways(edges)
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        sides.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of each node, and the node, to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; the root is its component's smallest node.

    Each round is two star steps whose minima are pre-aggregated, and is written
    to the shared folder, so that lineage stays short. Rounds end when the edges
    no longer change; their number grows with the logarithm of the longest path.
    Loops are allowed and give a node of its own; NULL ends are dropped.
    """
    edges = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL")
    start = store(edges.distinct(), "edges")
    edges = start.filter("u <> v")
    state = None
    while True:
        edges = store(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    nodes = _both_ways(start).select(F.col("u").alias("node")).distinct()
    return nodes.join(edges, F.col("node") == F.col("u"), "left").select(
        "node", F.coalesce("v", "node").alias("root")
    )
