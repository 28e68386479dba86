"""Silver and the dimension to published Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.operators.monthly import monthly_prices_of_places
from litro.operators.quality import published_report, validate_gold
from litro.session import scratch_folder, stage
from litro.sources.layers import publish_gold, read_dimension, read_gold, read_silver


def silver_to_gold(spark: SparkSession, silver: str, dimension: str, gold: str) -> list[str]:
    """Builds all months, validates, then publishes by year; returns the folders written.

    A price row without official municipality fails the validation, and nothing is published.
    """
    prices = read_silver(spark, silver)
    places = monthly_prices_of_places(prices, read_dimension(spark, dimension))
    with scratch_folder(spark, "silver-to-gold") as work:
        rows = stage(places, f"{work}/gold")
        validate_gold(rows)
        return publish_gold(rows, gold)


def check_published_gold(spark: SparkSession, gold: str) -> int:
    """Validates what is on disk; returns its row count."""
    rows = read_gold(spark, gold)
    validate_gold(rows)
    return rows.count()


def report_published_gold(spark: SparkSession, gold: str) -> DataFrame:
    """`published_report` of the files on disk."""
    rows = read_gold(spark, gold, with_year=True)
    return published_report(rows.withColumn("arquivo", F.col("_metadata.file_path")))
