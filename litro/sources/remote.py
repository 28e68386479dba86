"""Paths outside DataFrames: existence on the driver, single files opened inside a task."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Hadoop scheme names that Arrow spells differently.
ARROW_SCHEME = {"s3a": "s3", "s3n": "s3"}


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop file system, path with scheme and authority), by the cluster's own defaults."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = raw.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(raw)


def exists(spark: SparkSession, path: str) -> bool:
    store, full = hadoop_path(spark, path)
    return store.exists(full)


def qualified(spark: SparkSession, path: str) -> str:
    """Path as tasks need it: independent of the default file system and working folder."""
    return hadoop_path(spark, path)[1].toString()


def open_filesystem(path: str):
    """(Arrow file system, path inside it) for a path as Spark's listings give it."""
    from pyarrow import fs

    match = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)$", path)
    if match is None or match[1] == "file":
        return fs.LocalFileSystem(), match[3] if match else path
    scheme, authority, inner = match[1], match[2] or "", match[3]
    store, base = fs.FileSystem.from_uri(f"{ARROW_SCHEME.get(scheme, scheme)}://{authority}/")
    return store, base.rstrip("/") + inner


def first_line(path: str, step: int = 1 << 16) -> bytes:
    """The bytes before the first line end; reads only as far as needed."""
    store, inner = open_filesystem(path)
    head = b""
    with store.open_input_stream(inner) as stream:
        while b"\n" not in head:
            block = stream.read(step)
            if not block:
                break
            head += block
    return head.split(b"\n", 1)[0]
