"""Gapless row numbers inside groups of any size, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def buckets_for(rows: int, per_bucket: int = 50_000) -> int:
    """How many buckets keep each of them near ``per_bucket`` rows."""
    return max(1, -(-rows // per_bucket))


def numbered(df: DataFrame, group: list[str], bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... inside each ``group``, by (``bucket``, ``order``).

    A window over a whole group would put a hot group into one task.  Rows are
    numbered inside (group, bucket) instead, and each bucket starts where the
    buckets before it end; only the bucket counts meet in one window.
    """
    df = df.withColumn("_nb_bucket", bucket)
    keys = [*group, "_nb_bucket"]
    before = Window.partitionBy(*group).orderBy("_nb_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nb_n")).select(*keys, F.coalesce(F.sum("_nb_n").over(before), F.lit(0)).alias("_nb_start"))
    own = df.withColumn("_nb_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = [own[k].eqNullSafe(starts[k]) for k in keys]
    joined = own.join(starts, same, "inner").drop(*(starts[k] for k in keys))
    return joined.withColumn(out, F.col("_nb_start") + F.col("_nb_rank") - 1).drop("_nb_bucket", "_nb_rank", "_nb_start")
