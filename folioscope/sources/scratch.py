"""Lineage cuts that survive lost executors.

Intermediate tables are written as Parquet below the folder that the session
names in ``spark.checkpoint.dir`` and read back.  Only where that setting is
empty and the master is local (tests, notebooks) a temporary folder of our own
is set; on a cluster an empty setting is an error, as executors could not see
each other's files.  The files of a session go when the Python driver ends.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def base_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    said = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if said:
        return said.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="folioscope-")
        spark.sparkContext.setCheckpointDir(_own[app])
        atexit.register(_remove, spark, _own[app])
    return _own[app]


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = f"{base_dir(spark)}/folioscope/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for df in frames:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/folioscope/" in path:
                _remove(df.sparkSession, path)
