"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import ensure_checkpoint_dir


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """Hang neighbours on the smallest one: those above a node, or those not above it."""
    if upward:
        both = edges.union(edges.select("v", "u"))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    joined = both.join(low, "u")
    if upward:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", F.col("low").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges(u, v)``; root is the smallest node reachable.

    Each round contracts large and small stars; the depth of a component falls
    geometrically.  Hot nodes are met by counting before joining and by
    adaptive splits of the join.  Edges are checkpointed after each round, so a
    lost executor costs one round.  Nulls must not be among the nodes.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("u", "v").where("u <> v").distinct().checkpoint()
    state = None
    for _ in range(max_rounds):
        edges = _stars(_stars(edges, True), False).checkpoint()
        now = tuple(
            edges.agg(
                F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
            ).first()
        )
        if now == state:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = now
    raise RuntimeError("components did not settle")
