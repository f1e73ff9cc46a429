"""Intermediate results that several jobs read.

A staged result is a Parquet table in the cluster's shared checkpoint folder.
Unlike cached blocks it survives the loss of executors, it cuts the lineage,
and it gives the planner the true size of what was computed.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def work_folder(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir`` where it is set.

    Only a local session may fall back to a folder of its own, since on a
    cluster the executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tierflow-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


# Paths handed out and not released: deleted when the driver ends.
_open_paths: dict[str, SparkSession] = {}


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder that nothing has used before.

    What lies there is for this session: it is deleted when the driver ends,
    unless it is released before or given to ``keep``.
    """
    path = f"{work_folder(spark)}/tierflow/{label}-{uuid.uuid4().hex}"
    if not _open_paths:
        atexit.register(_release_all)
    _open_paths[path] = spark
    return path


def keep(path: str) -> str:
    """Leave a path alone when the driver ends."""
    _open_paths.pop(path, None)
    return path


def _release_all() -> None:
    for path, spark in list(_open_paths.items()):
        # A session that has been stopped cannot clean up any more.
        with suppress(Exception):
            release(spark, path)
    _open_paths.clear()


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once; return it as read back, and its path."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged table through the file system it lives on."""
    keep(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder, hidden files aside; nothing if there is no such folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    found = [s.getPath() for s in system.listStatus(target)]
    return [f.toString() for f in found if not f.getName().startswith((".", "_"))]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file in place of what may be at ``target``."""
    release(spark, target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    if not system.rename(path(source), path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for the length of a block."""
    result, path = stage(df, label)
    try:
        yield result
    finally:
        release(df.sparkSession, path)
