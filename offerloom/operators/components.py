"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Columns node, component: for every node of an edge, the least node it can reach.

    Each round links every node's larger neighbours to its least neighbour, then its smaller ones; the
    edges end as stars around each component's least node, after a number of rounds that grows with the
    logarithm of the longest path. Nodes are only ever aggregated to a minimum, so a node with very many
    edges is no burden for one task. A round's edges are written to the shared folder.
    """
    pairs = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    current = materialize(pairs.filter(F.col("a") != F.col("b")).distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = current.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = least.filter(F.col("m") < F.col("a")).select("a", F.col("m").alias("b"))
        large = larger.unionByName(own).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select("a", F.col("m").alias("b"))).filter("a <> b")
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        current = materialize(small, "edges")
        now = current.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
