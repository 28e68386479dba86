"""Parquet layers: where they live, how they are read and published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from litro.schemas import DIMENSION, GOLD, GOLD_GRAIN, PARTITION, SILVER
from litro.session import dropped_shuffles, open_folders
from litro.sources.files import require_files

PARQUET = "*.parquet"


def read_silver(spark: SparkSession, root: str, with_partition: bool = False) -> DataFrame:
    """Every Silver file stacked; ano and semestre exist only in the path unless asked for."""
    require_files(spark, root, PARQUET, "Silver prices")
    frame = spark.read.schema(SILVER).parquet(root)
    return frame if with_partition else frame.select(SILVER.fieldNames())


def read_dimension(spark: SparkSession, root: str) -> DataFrame:
    require_files(spark, root, PARQUET, "Municipality dimension")
    return spark.read.schema(DIMENSION).parquet(root)


def read_gold(spark: SparkSession, root: str, with_year: bool = False) -> DataFrame:
    require_files(spark, root, PARQUET, "Gold monthly prices")
    frame = spark.read.schema(GOLD).parquet(root)
    return frame if with_year else frame.select(GOLD.fieldNames())


def register_gold_view(spark: SparkSession, root: str, name: str = "precos_mensais") -> DataFrame:
    """SQL view over published Gold. It has `ano` from the path: filter on that to prune years."""
    frame = read_gold(spark, root, with_year=True)
    frame.createOrReplaceTempView(name)
    return frame


def write_partitioned(
    df: DataFrame, root: str, by: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Overwrites exactly the partitions present in `df`; others on disk stay.

    REBALANCE lets adaptive execution merge small partitions and split large ones by size, so
    neither many tiny files nor one task for a whole year or semester result. Rows are only sorted where
    files are to have an order.
    """
    dealt = df.hint("rebalance", *by)
    dealt = dealt.sortWithinPartitions(*by, *order) if order else dealt
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    with open_folders(df.sparkSession), dropped_shuffles(df.sparkSession):
        writer.parquet(root)


def publish_silver(df: DataFrame, root: str) -> None:
    """`ano=…/semestre=…` folders."""
    write_partitioned(df.select(*SILVER.fieldNames(), *PARTITION), root, PARTITION)


def publish_gold(df: DataFrame, root: str) -> list[str]:
    """`ano=…` folders, sorted by grain inside each file; returns the folders written."""
    seen = Observation()
    dated = df.select(*GOLD.fieldNames(), F.year("ano_mes").alias("ano")).observe(
        seen, F.collect_set("ano").alias("years")
    )
    write_partitioned(dated, root, ["ano"], GOLD_GRAIN)
    return [f"{root.rstrip('/')}/ano={year}" for year in sorted(seen.get["years"])]


def write_dimension(df: DataFrame, root: str) -> None:
    df.select(DIMENSION.fieldNames()).write.mode("overwrite").parquet(root)
