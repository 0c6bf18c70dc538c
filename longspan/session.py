"""Shared folder for derived tables that must be read back identically by every later stage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def _one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a temporary one will do on a single machine (tests); on a cluster every executor would write to a disk of
    its own, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not _one_machine(spark):
            raise ValueError("derived tables need a folder that all executors share: set spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="longspan-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed at the end of the innermost ``temporary`` block if there is one."""
    root = f"{shared_dir(spark).rstrip('/')}/longspan/{uuid.uuid4().hex}"
    if (paths := _scope.get()) is not None:
        paths.append(root)
    return f"{root}/{name}"


def pin(df: DataFrame) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Later jobs and retried tasks all see the same rows, its lineage ends here, scans read only the columns they need, and
    its size is known to the planner. Inside a ``temporary`` block the copy goes when the block ends; else it is left to the
    folder's owner.
    """
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run inside go when it ends, not when the driver next collects its garbage. For steps that
    are pinned: a table that is run again shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where it lies at the same place for them; elsewhere ship it with ``--py-files``."""
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df.mapInArrow(fn, schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables pinned inside are removed at the end; what a stage returns must be written elsewhere before."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove(spark, path)
