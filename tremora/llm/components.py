"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremora.llm.common import materialise


SALTS = 8  # parts of a node's links, so that a node with a third of all links is no single task


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Links (u, v) beside the least node m of their u."""
    salted = edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    copies = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), ["u", "_salt"])  # the copies are more than Spark's estimate says


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = _with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with a link to another; root is the smallest reachable node.

    ``links`` has long columns u and v in either order. Each round is two shuffles over
    at most as many rows as there are links; the rounds grow with the logarithm of the
    number of nodes. Rounds are written to the shared folder, so a lost executor costs
    no more than one round. Nothing is gathered on the driver but a count and a checksum.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialise(edges, "links"), None
    for _ in range(max_rounds):
        edges = materialise(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
