"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "litro", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own through spark-submit."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(cpus or 8),
        # Small tables: let a few MB be a task, or writes would run on one core.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.appName(app).master(f"local[{cpus or '*'}]")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="litro-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for staged tables, below the shared folder the cluster names.

    Only a local session may fall back to a temporary folder of this machine: on a cluster the
    executors would each see a different one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/litro/{purpose}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, target: str, *by: str) -> DataFrame:
    """Writes `df` below the shared working folder and reads it back: all that reads it shares one
    computation that outlives lost executors. by: columns whose values become folders."""
    with open_folders(df.sparkSession), dropped_shuffles(df.sparkSession):
        df.write.partitionBy(*by).parquet(target) if by else df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


#: Folders a task writes to at a time, at most, before it sorts what is left by folder.
OPEN_FOLDERS = 64


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another value of one setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def open_folders(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes into `key=value` folders without a sort by folder: a task keeps a file open in each."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS))


def dropped_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes whose shuffle files are deleted once the rows are written, not when the driver's memory is cleaned up:
    the disk then holds the shuffles of one write at a time."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A work folder that is deleted at the end, whether the work succeeds or fails."""
    folder = work_folder(spark, purpose)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
