"""Shared scratch space for tables that are written once and read again.

An intermediate that several branches read, or that must not be recomputed when
executors go away, is written as Parquet below the folder that the session names
in ``spark.checkpoint.dir``, or else below its warehouse. The file sizes of such a table are known to Catalyst
before the next query starts, so it broadcasts the table only when it is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise. All of it is
deleted when the application exits, or earlier by `temporary`.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; a path without a scheme is in the default file system."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly below `path`, none if it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


_application_dirs: set[str] = set()


def _application_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; deleted when it exits."""
    path = f"{shared_dir(spark)}/textlake/{spark.conf.get('spark.app.id')}"
    if path not in _application_dirs:
        fs, hadoop_path = _file_system(spark, path)
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _application_dirs.add(path)
    return path


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses, for this run only."""
    path = f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the paths handed out inside this block when it ends."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            fs, hadoop_path = _file_system(spark, path)
            fs.delete(hadoop_path, True)


def land(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder now and return a reader over it."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
