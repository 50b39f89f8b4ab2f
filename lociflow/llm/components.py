"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved)


def _print(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum over them, equal for equal edge sets."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], int(r["s"] or 0)


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every node of (a, b) that isn't the smallest of its component, that smallest node.

    Links may be repeated or join a node with itself.  Each round is written, so
    its lineage is short; the number of rounds grows with the logarithm of the
    size of a component.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    seen = _print(edges)
    while True:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "links")
        now = _print(edges)
        if now == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = now
