"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import checkpointed


def _minima(edges: DataFrame, key: str, value: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min(value).alias("_m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is linked with the least vertex of that neighbourhood. Rows are (hi, lo), hi > lo."""
    both = edges.select("hi", "lo").union(edges.select("lo", "hi")).toDF("u", "v")
    least = _minima(both, "u", "v").select(F.col("u"), F.least("u", "_m").alias("_m"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("hi"), F.col("_m").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its lower neighbours are all linked with the least of them."""
    least = _minima(edges, "hi", "lo")
    moved = edges.join(least, "hi").where(F.col("lo") != F.col("_m")).select(F.col("lo").alias("hi"), F.col("_m").alias("lo"))
    return moved.union(least.select("hi", F.col("_m").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (columns a, b) that is not the least of its component.

    Self-loops, repeated and reversed edges change nothing; NULL ends are ignored. A hub's edges are pre-aggregated
    for the minimum and then joined with one row for the hub, so its partition can be split.
    """
    current = checkpointed(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    state = None
    while True:
        digest = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        found = tuple(current.agg(F.count(F.lit(1)), digest).first())
        if found == state or not found[0]:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = found
        current = checkpointed(small_star(large_star(current)))
