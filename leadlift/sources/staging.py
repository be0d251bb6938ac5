"""Staged tables: intermediate results that several passes read.

A staged table is written once as Parquet below the shared folder the cluster names in ``spark.checkpoint.dir``.
It cuts the lineage, survives lost executors, and later passes read only the columns they need. Tables staged inside a
``scope`` are deleted at its end, except those that were staged to be kept.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_folder: dict[str, str] = {}
_dropped: dict[str, int] = {}
_scope: ContextVar[list[str] | None] = ContextVar("staged paths of the current scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a scratch folder, removed at exit, only for a local master with none set."""
    folder = spark.conf.get(SETTING, None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    if folder:
        if folder.startswith("file:") and not local:
            raise ValueError(f"{SETTING} is {folder}; executors on other machines cannot reach it")
        return folder.rstrip("/")
    if not local:
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    if context.applicationId not in _local_folder:
        made = tempfile.mkdtemp(prefix="leadlift-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_folder[context.applicationId] = made
    return _local_folder[context.applicationId]


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage; keeps a folder the session already has."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/leadlift/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None, keep: bool = False) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back, columns in the same order.

    With ``partition_by``, later filters on those columns read only the matching folders. Inside a scope the table goes
    when the scope ends, unless it is to be kept; then it belongs to the application, as do tables outside of scopes.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    if not keep and _scope.get() is not None:
        _scope.get().append(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, what was staged inside (by this thread) and not kept; nothing else is touched.

    Only for steps whose results no longer read those tables: values on the driver, or tables staged with ``keep``.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            _delete(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all of this application's staged tables; call it when nothing reads them any more."""
    application = spark.sparkContext.applicationId
    _dropped[application] = dropped(spark) + 1
    _delete(spark, f"{shared_folder(spark)}/leadlift/{application}")


def dropped(spark: SparkSession) -> int:
    """How often this application's staged tables were dropped; what holds on to them goes by it."""
    return _dropped.get(spark.sparkContext.applicationId, 0)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
