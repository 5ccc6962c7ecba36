"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import drop_table, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b: long); root is the smallest node of its component.

    Self loops and repeated edges are allowed, edges with a null end are ignored, an empty table gives an
    empty result. Each round is written to the shared folder; rounds grow with the logarithm of the size.
    """
    proper = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    loops = proper.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    now = materialise(proper.filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        stats = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if stats["n"] == 0 or (stats["n"], stats["s"]) == mark:
            break
        mark = (stats["n"], stats["s"])
        later = materialise(_small_star(_large_star(now).distinct()).filter("a <> b").distinct(), "edges")
        drop_table(now)
        now = later
    linked = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = linked.select("root").distinct().select(F.col("root").alias("node"), "root")
    found = linked.unionByName(roots)
    return found.unionByName(loops.distinct().join(found, "node", "left_anti"))
