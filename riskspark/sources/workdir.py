"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Where the tables that stage_table returned lie.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def work_root(setting: Callable[..., str | None]) -> str:
    """The folder for intermediate tables, given a way to look settings up."""
    root = setting("spark.checkpoint.dir", None)
    return (root or f"{setting('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, the warehouse stands in for it: the other folder that a session
    has in common with its executors. The part is removed when the application ends.
    """
    folder = f"{work_root(spark.conf.get)}/riskspark/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it.

    Used where a result is read more than once. Unlike a cache the table outlives its executors,
    and its real size is known to the planner: a small one is broadcast under
    ``spark.sql.autoBroadcastJoinThreshold``, a large one joins by shuffle, with no hint needed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stage_table`` returned, when all that was made of them is written.

    Frames that are no staged tables are left alone.
    """
    for table in tables:
        path = _paths.pop(table, None)
        if path is not None:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
