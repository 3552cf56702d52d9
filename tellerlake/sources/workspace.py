"""The shared folder for intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import SparkSession

#: Setting of a session: a statement's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Intermediate tables of the work under way, if it removes them.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A local session without that setting
    uses its warehouse folder; a cluster without it is an error, since the folder
    must be one that all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/tellerlake/{label}-{uuid4().hex}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, which ``scratch_removed`` removes."""
    path, under_way = new_dir(spark, label), _SCRATCH.get()
    if under_way is not None:
        under_way.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside go when it ends, so nothing that reads them may be handed on."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements inside remove their shuffle files when they end.

    Otherwise the files stay on the executors' disks until the driver happens to
    collect its garbage, and a run of many writes needs disk for all of them at once.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the cluster's own file interface; used for names only, never for data."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    system, target = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(target) if entry.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that is not needed any more."""
    system, target = _file_system(spark, path)
    system.delete(target, True)
