"""Connected components of a graph by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014), on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import materialize


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for each node that occurs in ``links`` (columns a, b, any integer ids);
    root is the smallest node reachable. Nodes in no link have no row. Self links are ignored."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        edges = materialize(_small(_large(edges)).where("u <> v").distinct(), "cc")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if state == seen:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
    raise RuntimeError("components didn't settle")
