"""Connected components of an edge table, without gathering a node's edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes of ``edges`` (a, b).

    Large-star and small-star steps in turn: each links the neighbours of a node
    to their minimum, found by an aggregation with partial sums and joined
    back, so a node with very many edges is no group of one task.  Rounds are
    logarithmic in practice; every round is cut by a written table.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, mark = cut(e, "edges"), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").filter("u <> v").distinct()
        e = cut(small, "small-star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
