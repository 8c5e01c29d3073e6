"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.sources.workspace import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its least neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the least of them; edges run down (a > b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("x"), "m").where("x <> m")
    return moved.select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def _tangled(edges: DataFrame) -> DataFrame:
    """Nodes that hang on several others, or hang on one and are hung upon; none are left in stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the component's least node.

    Each round's edges are written to the shared folder, so a lost executor costs one round. Nodes are
    only ever grouped by aggregates; no neighbour list is held in memory. Edges run down and a round keeps
    components, so it ends when the edges are stars: their centres are the least nodes.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    while True:
        edges = stage(_small_star(_large_star(edges)).distinct(), "cc")
        if _tangled(edges).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
