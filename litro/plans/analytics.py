"""The analytical questions over Gold: overview, regional prices, dispersion, fuel parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litro.functions.values import exact_mean, half_away
from litro.schemas import REGIONS

# The compared products and the parity threshold.
ETHANOL = "ETANOL"
GASOLINE = "GASOLINA"
PARITY = 0.70


def overview_count(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count(F.lit(1)).alias("quantidade_registros"))


def overview_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.min("ano_mes").alias("primeira_competencia"),
        F.max("ano_mes").alias("ultima_competencia"),
        F.count_distinct("codigo_ibge").alias("municipios"),
        F.count_distinct("produto").alias("produtos"),
    )


def overview_by_product(gold: DataFrame) -> DataFrame:
    """Rows and unweighted mean of monthly means."""
    return (
        gold.groupBy("produto")
        .agg(
            F.count(F.lit(1)).alias("registros"),
            half_away(exact_mean(F.col("preco_medio")), 2).alias("preco_medio"),
        )
        .orderBy("produto")
    )


def _weighted() -> list[Column]:
    # Amounts are summed as decimals: the same total, and so the same rounding of a tie, however
    # the rows are partitioned.
    amount = (F.col("preco_medio") * F.col("qtd_coletas")).cast("decimal(28,6)")
    weighted = F.sum(amount).cast("double") / F.sum("qtd_coletas")
    return [
        half_away(weighted, 2).alias("preco_medio_ponderado"),
        F.sum("qtd_coletas").alias("total_coletas"),
    ]


def price_by_region(gold: DataFrame) -> DataFrame:
    """Mean price weighted by observations."""
    return (
        gold.groupBy("regiao", "produto")
        .agg(*_weighted())
        .orderBy("produto", F.desc_nulls_last("preco_medio_ponderado"), "regiao")
    )


def price_by_region_and_year(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy(F.year("ano_mes").alias("ano"), "regiao", "produto")
        .agg(*_weighted())
        .orderBy("produto", "ano", F.desc_nulls_last("preco_medio_ponderado"), "regiao")
    )


def product_by_region_and_year(gold: DataFrame, product: str = GASOLINE) -> DataFrame:
    """One product's yearly price by region, in series order."""
    yearly = price_by_region_and_year(gold.where(F.col("produto") == product))
    return yearly.orderBy("regiao", "ano")


def region_matrix(
    long: DataFrame, value: str, regions: Sequence[str] | None = REGIONS
) -> DataFrame:
    """Products as rows, regions as columns; a missing pair is null, a repeated one an error.

    With `regions` given, the columns are fixed and no extra job looks for them; a row of another
    region, or of none, is an error and not lost.
    """
    if regions:
        name = F.coalesce("regiao", F.lit("null"))
        outside = F.raise_error(F.concat(F.lit("Region outside the list: "), name))
        known = F.coalesce(F.col("regiao").isin(list(regions)), F.lit(False))
        long = long.withColumn("regiao", F.when(known, F.col("regiao")).otherwise(outside))
    repeated = F.raise_error(F.lit("More than one value for a product and region"))
    cell = F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(value))
    grouped = long.groupBy("produto")
    pivoted = grouped.pivot("regiao", list(regions)) if regions else grouped.pivot("regiao")
    return pivoted.agg(cell).orderBy("produto")


def dispersion_by_region(gold: DataFrame) -> DataFrame:
    """Unweighted mean of the monthly standard deviations that exist."""
    return (
        gold.where(F.col("desvio_padrao").isNotNull())
        .groupBy("regiao", "produto")
        .agg(
            half_away(exact_mean(F.col("desvio_padrao")), 3).alias("desvio_padrao_medio"),
            F.count("desvio_padrao").alias("total_municipios_mes"),
        )
        .orderBy("produto", F.desc_nulls_last("desvio_padrao_medio"), "regiao")
    )


def parity(gold: DataFrame) -> DataFrame:
    """Ethanol to gasoline price, where a municipality has both in a month.

    Both filters reach the scan, which reads two products and the needed columns only.
    """
    keys = ["ano_mes", "codigo_ibge"]
    ethanol = gold.where(F.col("produto") == ETHANOL).select(
        *keys, "municipio", "uf", "regiao", F.col("preco_medio").alias("preco_etanol")
    )
    gasoline = gold.where(F.col("produto") == GASOLINE).select(
        *keys, F.col("preco_medio").alias("preco_gasolina")
    )
    ratio = half_away(F.col("preco_etanol") / F.col("preco_gasolina"), 3)
    return ethanol.join(gasoline, keys).withColumn("razao_etanol_gasolina", ratio).orderBy(*keys)


def parity_share(ratios: DataFrame, *by: str) -> DataFrame:
    """Pairs, pairs below the threshold (after rounding) and their percentage."""
    below = F.count_if(F.col("razao_etanol_gasolina") < PARITY)
    total = F.count(F.lit(1))
    share = F.try_divide(F.lit(100.0) * below, total)
    shares = ratios.groupBy(*by).agg(
        total.alias("total"),
        below.alias("abaixo_070"),
        half_away(share, 2).alias("percentual_abaixo_070"),
    )
    return shares.orderBy(F.desc_nulls_last("percentual_abaixo_070"), *by) if by else shares
