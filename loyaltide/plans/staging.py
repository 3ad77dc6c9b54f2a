"""Cutting lineage with tables written to the cluster's shared folder, and removing them again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

LOCAL_SHARED = "/tmp/checkpoints"  # for local masters only, where driver and executors are one process
_open: ContextVar[tuple[Staged, ...]] = ContextVar("open_scopes", default=())


class Staged:
    """The folders written while a scope was open; ``remove`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def remove(self) -> None:
        for path in self.paths:
            remove_path(self.spark, path)
        self.paths.clear()


@contextmanager
def staged_in(spark: SparkSession) -> Iterator[Staged]:
    """Collects what ``stage`` and ``scratch_path`` hand out inside the block.

    Results may still read those folders after the block, so the caller calls
    ``remove()`` on the handle once it has written or collected its result.
    """
    scope = Staged(spark)
    token = _open.set((*_open.get(), scope))
    try:
        yield scope
    finally:
        _open.reset(token)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a cluster that setting is required: a folder of this library's own
    choice would exist on one machine alone. ``local-cluster`` counts as one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    return LOCAL_SHARED


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder, grouped by application for cleaning up."""
    application = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/loyaltide/{application}/{label}-{uuid.uuid4().hex}"
    for scope in _open.get():
        scope.paths.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several passes need the result of a long plan. Unlike a cached
    table it survives the loss of an executor, and unlike ``checkpoint()`` it is
    columnar, so each later pass reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
