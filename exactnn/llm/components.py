"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step on (u, v), u > v: neighbours meet the smallest of a node's neighbourhood.

    The large step moves larger neighbours, the small one smaller ones and the node itself. Only
    minima are gathered, pre-aggregated before the shuffle; a node of many edges is a skewed join
    whose other side has one row a node.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m")
        moved = edges.join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge, with the smallest node that it reaches.

    Edges may repeat, run either way, or join a node with itself. Steps are stored in the shared
    folder; their number grows with the logarithm of the longest chain.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = materialize(pairs, "edges")
    state = None
    while True:
        pairs = materialize(_stars(_stars(pairs, large=True), large=False), "stars")
        now = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("all")
        ).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
