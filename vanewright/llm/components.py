"""Connected components of links between ids, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.session import forget, written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): component is the smallest node reachable.

    Large-star and small-star steps in turn, each written to shared storage, until a round changes nothing. Minima are
    taken with partial aggregation, so a node with very many links is no task of its own.
    """
    edges = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("least").alias("v")
        ).distinct()
        large = written(large, "large-star")
        small_least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(small_least, "u")
        more = small.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        old, edges = edges, written(more.union(small_least.select("u", "least")).distinct(), "small-star")
        forget(old, large)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
