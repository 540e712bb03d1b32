"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import written

MAX_ROUNDS = 60


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over (a, b) with a > b: neighbours move to the smallest node around theirs."""
    if larger:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    joined = around.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
        return moved.filter("a != b").distinct()
    moved = joined.filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _crooked(edges: DataFrame) -> int:
    """Nodes of (a, b) with several smaller neighbours, or with a smaller and a larger one: none in a set of stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    sides = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return sides.filter(F.col("below") + F.col("above") * F.signum("below") > 1).agg(F.count("*")).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node reached.

    Links may repeat, stand in either order or join a node to itself (then it gets
    no row unless another link has it). Every round is written to the shared
    folder, so its lineage stays short; rounds end when only stars are left. No links give no rows.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    for _ in range(MAX_ROUNDS):
        if not _crooked(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = written(_starred(_starred(edges, True), False), "links")
    raise RuntimeError("links didn't settle")
