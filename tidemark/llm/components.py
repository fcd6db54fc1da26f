"""Connected components of a distributed edge list by alternating star contraction.

Every round replaces edges by edges to smaller neighbours (large-star, then
small-star) until only stars are left, in a number of rounds that grows with the
logarithm of the longest path.  Neighbours are never gathered: a round is two
minimum aggregations and two joins.  Each round's edges are written to the
shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u, v of one ordered type.  Returns (node, root) for all
    nodes but the roots; a root is the smallest node of its component."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))  # each node with its larger neighbours
        large = large.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialize(edges.where("u <> v").distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
