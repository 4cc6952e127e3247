"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.scratch import materialize


def fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; two sums over 64-bit hashes."""
    a, b = F.xxhash64("u", "v").cast("decimal(38,0)"), F.xxhash64("v", "u").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(a), F.sum(b)).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for each node of ``edges(a, b)``; component: the smallest node reached.

    Alternates large-star and small-star steps: each node's larger neighbours,
    then its smaller ones, are hung on the smallest node around it, until the
    edges are stars.  Every step is an aggregation and a join; a hub's
    neighbours are never gathered in one row.  Edges are not collected anywhere.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    after = fingerprint(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, f"{name}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = materialize(small, f"{name}-small")
        now, before, after = small, after, fingerprint(small)
        if before == after:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
