"""Monthly price statistics by municipality and product.

Two steps. First a price histogram: rows are counted per key and price, with map-side combine and
a shuffle that includes the price, so one very frequent key is spread over all tasks and shrinks
to its distinct prices. Then the exact statistics per key are taken from the counts; the running
count that finds the median is a window over sorted, spillable rows, never a list in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litro.functions.values import month_of
from litro.operators.municipalities import enrich
from litro.schemas import GOLD, GOLD_KEYS

PLACE_KEYS = ("ano_mes", "uf", "municipio", "produto")


def price_histogram(prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observations per key and price (null is a key and a price like any other)."""
    return (
        prices.withColumn("ano_mes", month_of(F.col("data_coleta")))
        .groupBy(*keys, "valor_venda")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def price_statistics(histogram: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """Mean, exact median, minimum, maximum, sample deviation and count from (keys, price, n), where a price may
    come in several rows of a key."""
    ordered = Window.partitionBy(*keys).orderBy("valor_venda")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    price = F.col("valor_venda")
    priced = F.when(price.isNotNull(), F.col("n")).otherwise(F.lit(0))
    ranked = histogram.select(
        *keys,
        price,
        "n",
        priced.alias("priced"),
        F.sum(priced).over(running).alias("up_to"),
        F.sum(priced).over(group).alias("total"),
        # Sums of decimals are exact, whatever the order the rows arrive in.
        F.sum(price * F.col("n").cast("decimal(18,0)")).over(group).alias("amount"),
    )
    mean = F.try_divide(F.col("amount").cast("double"), F.col("total"))
    off = price.cast("double") - mean
    # The two middle observations (the same one for an odd count).
    lower = F.min(F.when(F.expr("up_to >= (total + 1) div 2"), price)).cast("double")
    upper = F.min(F.when(F.expr("up_to >= total div 2 + 1"), price)).cast("double")
    return ranked.groupBy(*keys).agg(
        F.max(mean).alias("preco_medio"),
        ((lower + upper) / 2).alias("preco_mediano"),
        F.min(price).cast("double").alias("preco_minimo"),
        F.max(price).cast("double").alias("preco_maximo"),
        F.sqrt(F.try_divide(F.sum(F.col("n") * off * off), F.max("total") - 1)).alias(
            "desvio_padrao"
        ),
        F.sum("n").alias("qtd_coletas"),
    )


def monthly_prices(enriched: DataFrame) -> DataFrame:
    """Gold rows from enriched Silver rows."""
    return price_statistics(price_histogram(enriched, GOLD_KEYS)).select(GOLD.fieldNames())


def monthly_prices_of_places(silver: DataFrame, dimension: DataFrame) -> DataFrame:
    """Same rows from Silver and the dimension, counting before matching.

    Equal to `monthly_prices(enrich(silver, dimension))`: the match depends only on state and
    name, and counts add up when names of one municipality meet. Far fewer rows are folded,
    joined and shuffled on the wide key, and that once: the statistics take a price in several rows.
    """
    counted = price_histogram(silver, PLACE_KEYS)
    return price_statistics(enrich(counted, dimension)).select(GOLD.fieldNames())


def sorted_prices(gold: DataFrame) -> DataFrame:
    return gold.orderBy("ano_mes", "codigo_ibge", "produto")


def preview(gold: DataFrame, n: int = 10) -> DataFrame:
    """First rows by grain; a top-n, not a full sort."""
    return sorted_prices(gold).limit(n)
