"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest one around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    return (
        tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (longs); the root is the
    smallest node reachable.

    Each round is stored in the shared folder, so that lineage stays short; the
    number of rounds grows with the logarithm of the size of a component. Edges
    with a null end or equal ends are passed over; no edges give no rows.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges = store(edges.filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        edges = store(_small_star(_large_star(edges)), "edges")
        sums = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if sums == seen or not sums[0]:
            break
        seen = sums
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
