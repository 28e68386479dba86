"""File listings as tables: discovery, path metadata, pending work and coverage.

A listing is a `binaryFile` scan whose `content` column is pruned, so Spark lists the folder (in
parallel when it is large) and opens no file. Partition values come from the folder names.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.schemas import PARTITION
from litro.sources.remote import exists


def list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """One row per file below `root`: path, arquivo (the path as `_metadata.file_path` spells it), size and the
    values of its `key=value` folders."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(root)
        .withColumn("arquivo", F.col("_metadata.file_path"))
        .drop("content", "modificationTime")
    )


def discover(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Sorted paths of matching files; the extension is matched case-sensitively."""
    return list_files(spark, root, glob).select("path").orderBy("path")


def partition_metadata(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """path, arquivo, ano, semestre of every file; a path without those folders is an error."""
    files = list_files(spark, root, glob)
    missing = [c for c in PARTITION if c not in files.columns]
    if missing:
        raise ValueError(f"No partition folders {missing} below {root}")
    return files.select("path", "arquivo", *[F.col(c).cast("int").alias(c) for c in PARTITION])


def partitions(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(ano, semestre, arquivos): materialised partitions; none if the folder does not exist."""
    if not has_files(spark, root, glob):
        return spark.createDataFrame([], "ano int, semestre int, arquivos bigint")
    return (
        partition_metadata(spark, root, glob)
        .groupBy(*PARTITION)
        .agg(F.count(F.lit(1)).alias("arquivos"))
    )


def pending(landed: DataFrame, done: DataFrame) -> DataFrame:
    """Landed partitions without output. Existence counts, not content."""
    return landed.join(done.select(*PARTITION).distinct(), list(PARTITION), "left_anti")


def expected_partitions(spark: SparkSession, years: range, halves: Iterable[int] = (1, 2)):
    """The (ano, semestre) grid a complete history has."""
    halves = tuple(halves)
    if not set(halves) <= {1, 2}:
        raise ValueError(f"Invalid semester in {halves}; expected 1 or 2.")
    return spark.range(years.start, years.stop).select(
        F.col("id").cast("int").alias("ano"),
        F.explode(F.array(*[F.lit(h) for h in halves])).alias("semestre"),
    )


def coverage_gaps(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected partitions that never landed."""
    return pending(expected, landed)


def has_files(spark: SparkSession, root: str, glob: str) -> bool:
    return exists(spark, root) and not list_files(spark, root, glob).select("path").isEmpty()


def require_files(spark: SparkSession, root: str, glob: str, what: str) -> None:
    if not has_files(spark, root, glob):
        raise FileNotFoundError(f"{what} not found below {root}")


def inputs_report(spark: SparkSession, inputs: dict[str, tuple[str, str]]) -> DataFrame:
    """(camada, presente, particoes): for each named (folder, file pattern), whether it has files, and in how
    many folders. A folder that does not exist has none."""

    def one(name: str, root: str, glob: str) -> DataFrame:
        if exists(spark, root):
            folder = F.regexp_replace("arquivo", "/[^/]*$", "")
            found = list_files(spark, root, glob).agg(F.count_distinct(folder).alias("particoes"))
        else:
            found = spark.range(1).select(F.lit(0).cast("bigint").alias("particoes"))
        return found.select(F.lit(name).alias("camada"), (F.col("particoes") > 0).alias("presente"), "particoes")

    return reduce(DataFrame.unionByName, [one(name, *where) for name, where in inputs.items()])
