"""Shared folder for intermediate tables that must be computed exactly once.

A written table survives the loss of any executor and gives every later reader
the same rows in the same files, which a cached or recomputed frame does not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def workspace_dir(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``.

    A temporary folder stands in for an unset ``spark.checkpoint.dir`` in local
    mode only: on a cluster the executors would not see each other's files.
    """
    context = spark.sparkContext
    app = context.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="keygroup-")
        root = _local_dirs[app]
    return f"{root.rstrip('/')}/keygroup-{app}"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{workspace_dir(spark)}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def temporary(df: DataFrame, tag: str) -> Iterator[DataFrame]:
    """Like ``materialise``, for a table that is not needed after the block."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def materialise(df: DataFrame, tag: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return a frame over the written files.

    The folder is added to ``paths``, for an owner that deletes it after use.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_workspace(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, and nothing else."""
    return delete(spark, workspace_dir(spark))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store it is; whether there was one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
