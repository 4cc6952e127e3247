"""Lineage cuts of the training-data operators: those of the engine's sources, and one for tables that Python steps make."""

from __future__ import annotations

from pyspark.sql import DataFrame

from folioscope.sources.scratch import base_dir, materialize, release

__all__ = ["BATCH", "base_dir", "materialize", "materialize_in_batches", "release"]

BATCH = 4 << 20  # bytes of an Arrow batch on its way to Python
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def materialize_in_batches(df: DataFrame, name: str) -> DataFrame:
    """materialize() for a table whose rows pass through Python, in batches of about ``BATCH`` bytes.

    Spark's own limit is 64 MB.  An executor holds a batch several times (vectors,
    the buffer before the socket, the worker's copy) for each task at once, and all
    of it outside its heap.  The session's setting is put back afterwards."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH_SETTING)
    conf.set(BATCH_SETTING, str(BATCH))
    try:
        return materialize(df, name)
    finally:
        conf.set(BATCH_SETTING, before)
