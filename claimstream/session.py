"""Session helpers: the shared folder every job writes its intermediate data to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimstream")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.claimstream.partitions", os.cpu_count() if cores == "*" else cores)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a scratch folder in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="claimstream-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nobody has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def folder_numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of an integer partition column that a folder has, from its names alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    names = [status.getPath().getName() for status in system.listStatus(where)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{column}="))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``cut`` writes inside go when the block ends; scopes are per thread.

    A streaming job runs every micro-batch in one, or its checkpoints would pile up.
    """
    before, _scope.folder = getattr(_scope, "folder", None), fresh_path(spark, "scratch")
    try:
        yield
    finally:
        remove(spark, _scope.folder)
        _scope.folder = before


def cut(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder; lineage ends here."""
    folder = getattr(_scope, "folder", None)
    if folder is None:
        shared_folder(df.sparkSession)
        return df.checkpoint()
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
