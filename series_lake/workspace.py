"""Scratch folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine:
    on a cluster such a folder is invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="series-lake-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses. It is not created."""
    return f"{shared_root(spark)}/series_lake/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged copy once everything derived from it is written."""
    if not path.startswith(f"{shared_root(spark)}/series_lake/"):
        raise ValueError(f"not a scratch path: {path}")
    remove(spark, path)


@contextmanager
def staged(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path that is removed when the block ends, also by an error."""
    path = scratch(spark, label)
    try:
        yield path
    finally:
        discard(spark, path)
