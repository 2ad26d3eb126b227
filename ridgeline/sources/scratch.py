"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables.

    The session's ``spark.checkpoint.dir`` decides. Where it is unset, a folder
    on this machine serves a local master only: on a cluster the executors
    could not see it, so that case is an error.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    app = sc.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ridgeline-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of it, under another ``schema`` of the same layout if one is given.

    For frames that several passes read: the joins behind them run once, later
    passes get column pruning and filter pushdown from the files, and a lost
    executor costs one re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def discard_staged(spark: SparkSession) -> None:
    """Delete the tables that ``staged`` wrote for this application, once no result needs them."""
    sc = spark.sparkContext
    for name in _written.pop(sc.applicationId, []):
        path = sc._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
