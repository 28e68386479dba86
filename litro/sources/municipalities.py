"""The official municipality list as landed JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litro.schemas import MUNICIPALITY_JSON


def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    """JSON array(s) of nested records. The schema is given, so nothing is sampled or inferred."""
    return spark.read.schema(MUNICIPALITY_JSON).option("multiLine", True).json(path)
