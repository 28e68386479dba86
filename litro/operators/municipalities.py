"""Municipality dimension and the match of price rows against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litro.functions.text import fold_text
from litro.schemas import PARTITION

MATCH = ["uf", "municipio_match"]


def flatten_municipalities(records: DataFrame) -> DataFrame:
    """Nested official records to code, name, state, region and match key."""
    state = "`regiao-imediata`.`regiao-intermediaria`.UF"
    return records.select(
        F.col("id").cast("string").alias("codigo_ibge"),
        F.col("nome").alias("municipio"),
        F.col(f"{state}.sigla").alias("uf"),
        F.col(f"{state}.regiao.nome").alias("regiao"),
        fold_text(F.col("nome")).alias("municipio_match"),
    )


def enrich(prices: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left match on state and folded name; official name and region replace the source's.

    No broadcast hint: the dimension is read from files, so its size is known when the join is
    planned and checked against the broadcast threshold; a larger one falls back to a shuffled
    join, where adaptive execution splits a state or city that holds much of the data.
    """
    official = dimension.select(
        *MATCH, "codigo_ibge", F.col("municipio").alias("_name"), F.col("regiao").alias("_region")
    )
    others = [c for c in prices.columns if c not in ("municipio", "regiao")]
    return (
        prices.withColumn("municipio_match", fold_text(F.col("municipio")))
        .join(official, MATCH, "left")
        .select(
            *others,
            "codigo_ibge",
            F.col("_name").alias("municipio"),
            F.col("_region").alias("regiao"),
        )
    )


def match_coverage(prices: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows and rows without a code, per partition.

    Prices are counted per place before the match, so names are folded and joined once per
    distinct place instead of once per row.
    """
    places = prices.groupBy(*PARTITION, "uf", "municipio").agg(F.count(F.lit(1)).alias("n"))
    coded = enrich(places, dimension)
    return coded.groupBy(*PARTITION).agg(
        F.sum("n").alias("linhas"),
        F.sum(F.when(F.col("codigo_ibge").isNull(), F.col("n")).otherwise(0)).alias("sem_codigo"),
    )


def ambiguous_match_keys(dimension: DataFrame) -> DataFrame:
    """Match keys that several municipalities share: a join on them would multiply price rows."""
    return (
        dimension.groupBy(*MATCH)
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .where("quantidade > 1")
    )
