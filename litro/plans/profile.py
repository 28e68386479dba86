"""Profile of the raw files as they are on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.operators.profiling import counted_values, partition_profile, value_rows
from litro.schemas import PARTITION
from litro.session import scratch_folder, stage, work_folder
from litro.sources.delimited import file_headers, scan_bronze, stage_lines


def profile_bronze(spark: SparkSession, bronze: str, glob: str = "*.csv") -> DataFrame:
    """`partition_profile`, with columns and nulls limited to what each partition's files have.

    The raw text is read once, whatever the number of headers, into a staged table of its fields; that is read for
    the profile and deleted.
    """
    headers = stage(file_headers(spark, bronze, glob), work_folder(spark, "headers"))
    with scratch_folder(spark, "bronze-profile") as work:
        lines = stage_lines(scan_bronze(spark, bronze, glob, headers), f"{work}/lines")
        profile = partition_profile(lines, reread=True)
    own = headers.groupBy(*PARTITION).agg(
        F.array_distinct(F.flatten(F.collect_set("colunas"))).alias("colunas")
    )
    return (
        profile.drop("colunas", "total_colunas")
        .join(own, list(PARTITION), "left")
        .withColumns(
            {
                "total_colunas": F.size("colunas").cast("bigint"),
                "nulos": F.map_filter("nulos", lambda c, _: F.array_contains("colunas", c)),
            }
        )
    )


def bronze_values(spark: SparkSession, bronze: str, glob: str = "*.csv") -> DataFrame:
    """Every value of the listed columns of the raw files, with its number of rows."""
    return value_rows(counted_values(scan_bronze(spark, bronze, glob)))
