"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables, named by `spark.checkpoint.dir`.

    Only a session on a local master may do without that setting: it gets a folder of
    its own. On a cluster every executor would write to its own disk, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(context.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/archivekit/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, staged: list[str] | None = None) -> DataFrame:
    """Write `df` as a table and read it back: lineage is cut, size is known.

    The table's folder is added to `staged`, for `discard` once it is no longer read.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    if staged is not None:
        staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a table was ever written there; `*` and `{a,b}` stand for several folders."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    folders.clear()
