"""One query per operator, on the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.functions import text, values
from litro.functions.values import named
from litro.operators import cleaning, contract, monthly, municipalities, profiling, quality
from litro.plans import analytics, profile
from litro.plans.silver_to_gold import report_published_gold
from litro.schemas import DIMENSION, GOLD, PARTITION, PRODUCTS, SILVER, STATES, UNITS
from litro.sources import delimited, files, layers
from litro.sources.municipalities import read_municipalities
from litro.workload import folders, views
from litro.workload.folders import observed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as other engines hand them out."""
    decimals = [c for c, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: named(c).cast("double") for c in decimals})


def rounded_deviation(gold: DataFrame) -> DataFrame:
    """The deviation to six places: its last bits depend on the order of summation."""
    return gold.withColumn("desvio_padrao", F.round("desvio_padrao", 6))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.read_gold(spark, folders.direct_gold(spark, sf_dir))


# --- Gold -------------------------------------------------------------------------------------


@query
def gold_monthly_prices(spark, sf_dir):
    return rounded_deviation(monthly.monthly_prices(views.enriched(observed(spark, sf_dir))))


@query
def gold_sorted(spark, sf_dir):
    return rounded_deviation(monthly.sorted_prices(published(spark, sf_dir)))


@query
def gold_preview_topn(spark, sf_dir):
    return rounded_deviation(monthly.preview(published(spark, sf_dir), 10))


# --- Analytics --------------------------------------------------------------------------------


@query
def overview_count(spark, sf_dir):
    return analytics.overview_count(published(spark, sf_dir))


@query
def overview_summary(spark, sf_dir):
    return analytics.overview_summary(published(spark, sf_dir))


@query
def overview_by_product(spark, sf_dir):
    return analytics.overview_by_product(published(spark, sf_dir))


@query
def q1_region_product(spark, sf_dir):
    return analytics.price_by_region(published(spark, sf_dir))


@query
def q1_region_year(spark, sf_dir):
    return analytics.price_by_region_and_year(published(spark, sf_dir))


@query
def q1_gasoline_year(spark, sf_dir):
    return analytics.product_by_region_and_year(published(spark, sf_dir))


@query
def q1_pivot(spark, sf_dir):
    prices = analytics.price_by_region(published(spark, sf_dir))
    return analytics.region_matrix(prices, "preco_medio_ponderado")


@query
def q4_dispersion(spark, sf_dir):
    return analytics.dispersion_by_region(published(spark, sf_dir))


@query
def q4_pivot(spark, sf_dir):
    dispersion = analytics.dispersion_by_region(published(spark, sf_dir))
    return analytics.region_matrix(dispersion, "desvio_padrao_medio")


@query
def q5_ratio(spark, sf_dir):
    return analytics.parity(published(spark, sf_dir))


@query
def q5_summary(spark, sf_dir):
    return analytics.parity_share(analytics.parity(published(spark, sf_dir)))


@query
def q5_by_region(spark, sf_dir):
    return analytics.parity_share(analytics.parity(published(spark, sf_dir)), "regiao")


@query
def q5_by_state(spark, sf_dir):
    return analytics.parity_share(analytics.parity(published(spark, sf_dir)), "uf", "regiao")


# --- Scalar functions -------------------------------------------------------------------------


@query
def decimal_comma(spark, sf_dir):
    """A second comma is appended, so that only the first may change."""
    price = named("Valor de Venda")
    entry = F.concat(price, F.lit(","), named("Numero Rua")).alias("entrada")
    raw = views.raw(observed(spark, sf_dir)).select(entry)
    return raw.select("entrada", values.decimal_comma(F.col("entrada")).alias("saida"))


@query
def digits_only(spark, sf_dir):
    return views.raw(observed(spark, sf_dir)).select(
        values.digits_only(named("CNPJ da Revenda")).alias("cnpj_revenda"),
        values.digits_only(named("Cep")).alias("cep"),
    )


@query
def date_parse(spark, sf_dir):
    day = named("Data da Coleta")
    return views.raw(observed(spark, sf_dir)).select(
        day.alias("texto"), values.to_date(day).alias("data_coleta")
    )


@query
def decimal_cast(spark, sf_dir):
    price = named("Valor de Venda")
    return comparable(
        views.raw(observed(spark, sf_dir)).select(
            price.alias("texto"),
            values.to_price(values.decimal_comma(price)).alias("valor_venda"),
        )
    )


@query
def unit_normalize(spark, sf_dir):
    unit = named("Unidade de Medida")
    return (
        views.raw(observed(spark, sf_dir))
        .select(unit.alias("original"), values.unit_spelling(unit).alias("unidade_medida"))
        .groupBy("original", "unidade_medida")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


@query
def month_trunc(spark, sf_dir):
    return (
        views.silver(observed(spark, sf_dir))
        .groupBy(values.month_of(F.col("data_coleta")).alias("ano_mes"))
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


@query
def text_fold(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.fold_text(F.col("text")).alias("chave"))


@query
def text_fold_udf(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.fold_text_udf(F.col("text")).alias("chave"))


@query
def max_decimal_places(spark, sf_dir):
    prices = views.silver(observed(spark, sf_dir)).select(F.col("valor_venda").cast("string"))
    return profiling.max_decimal_places(prices, "valor_venda")


@query
def struct_path(spark, sf_dir):
    state = "`regiao-imediata`.`regiao-intermediaria`.UF"
    return views.municipality_records(spark, sf_dir).select(
        "id", F.col(f"{state}.sigla").alias("uf"), F.col(f"{state}.regiao.nome").alias("regiao")
    )


# --- Cleaning ---------------------------------------------------------------------------------


@query
def select_rename(spark, sf_dir):
    return cleaning.select_silver_names(views.raw(observed(spark, sf_dir)))


@query
def optional_columns(spark, sf_dir):
    raw = views.raw(observed(spark, sf_dir)).drop("Bandeira", "Cep")
    return cleaning.select_silver_names(cleaning.add_optional_columns(raw))


@query
def drop_blank_rows(spark, sf_dir):
    return views.plain_names(cleaning.drop_blank_rows(views.raw(observed(spark, sf_dir))))


@query
def exact_dedup(spark, sf_dir):
    return views.plain_names(cleaning.drop_exact_duplicates(views.raw(observed(spark, sf_dir)), reread=True))


@query
def silver_transform(spark, sf_dir):
    return comparable(cleaning.to_silver(views.raw(observed(spark, sf_dir)), reread=True))


@query
def distinct_values(spark, sf_dir):
    return profiling.distinct_values(views.raw(observed(spark, sf_dir)), "Unidade de Medida")


@query
def distinct_sorted(spark, sf_dir):
    return profiling.distinct_sorted(views.raw(observed(spark, sf_dir)), "Produto")


@query
def union_all(spark, sf_dir):
    silver = views.silver(observed(spark, sf_dir))
    return comparable(silver.unionByName(views.faulty(observed(spark, sf_dir))))


# --- Municipalities ---------------------------------------------------------------------------


@query
def municipality_dimension(spark, sf_dir):
    return layers.read_dimension(spark, folders.dimension(spark, sf_dir))


@query
def json_nested_scan(spark, sf_dir):
    state = "`regiao-imediata`.`regiao-intermediaria`.UF"
    return read_municipalities(spark, folders.payload(spark, sf_dir)).select(
        "id",
        "nome",
        F.col(f"{state}.sigla").alias("sigla"),
        F.col(f"{state}.regiao.nome").alias("regiao"),
    )


@query
def enrich_municipality(spark, sf_dir):
    dimension = layers.read_dimension(spark, folders.dimension(spark, sf_dir))
    prices = views.misspelt(observed(spark, sf_dir)).drop(*PARTITION)
    return comparable(municipalities.enrich(prices, dimension))


@query
def unmatched_municipalities(spark, sf_dir):
    dimension = layers.read_dimension(spark, folders.dimension(spark, sf_dir))
    return municipalities.match_coverage(views.misspelt(observed(spark, sf_dir)), dimension)


@query
def check_join_key_unique(spark, sf_dir):
    """Customers' nations as a list with repeats: every key several customers share."""
    people = views.table(spark, sf_dir, "customer").join(
        views.places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = text.fold_text(F.col("municipio_oficial")).alias("municipio_match")
    return municipalities.ambiguous_match_keys(people.select("uf", key))


# --- Quality ----------------------------------------------------------------------------------


@query
def schema_drift(spark, sf_dir):
    """Headers of the raw files, as if two columns had been left out of all of them."""
    headers = delimited.file_headers(spark, folders.bronze(spark, sf_dir))
    fewer = F.array_except("colunas", F.array(F.lit("Cep"), F.lit("Produto")))
    drift = delimited.header_drift(headers.withColumn("colunas", fewer))
    return drift.select(*PARTITION, "coluna", "problema").distinct()


@query
def check_price_positive(spark, sf_dir):
    return quality.report(views.faulty(observed(spark, sf_dir)), [quality.price_rule()], PARTITION)


@query
def check_required(spark, sf_dir):
    rules = quality.required_rules(quality.SILVER_REQUIRED)
    return quality.report(views.faulty(observed(spark, sf_dir)), rules)


@query
def check_cnpj(spark, sf_dir):
    return quality.report(views.faulty(observed(spark, sf_dir)), [quality.cnpj_rule()], PARTITION)


@query
def check_allowed_values(spark, sf_dir):
    allowed = {"produto": PRODUCTS, "unidade_medida": UNITS, "uf": STATES}
    return quality.offending_values(views.faulty(observed(spark, sf_dir)), allowed)


@query
def silver_quality_report(spark, sf_dir):
    return quality.report(views.faulty(observed(spark, sf_dir)), quality.silver_rules())


def doubtful_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.doubtful(published(spark, sf_dir))


@query
def check_gold_grain(spark, sf_dir):
    return quality.duplicate_keys(doubtful_gold(spark, sf_dir), quality.GOLD_GRAIN)


@query
def check_gold_required(spark, sf_dir):
    rules = quality.required_rules(quality.GOLD_REQUIRED)
    return quality.report(doubtful_gold(spark, sf_dir), rules)


@query
def check_gold_metrics(spark, sf_dir):
    return quality.report(doubtful_gold(spark, sf_dir), [quality.metrics_rule()])


@query
def gold_quality_report(spark, sf_dir):
    return quality.gold_report(doubtful_gold(spark, sf_dir))


@query
def gold_published_report(spark, sf_dir):
    """The report on each published file, added up by year, as file names and numbers are the writer's own."""
    found = report_published_gold(spark, folders.doubtful_gold(spark, sf_dir))
    return found.groupBy("ano", "check").agg(
        F.sum("linhas").alias("linhas"), F.sum("violations").alias("violations")
    )


@query
def contract_report(spark, sf_dir):
    """Silver and Gold with altered columns against their contracts."""
    altered = {
        "silver": (views.altered_silver(observed(spark, sf_dir)), SILVER),
        "gold": (views.altered_gold(published(spark, sf_dir)), GOLD),
    }
    parts = [
        contract.contract_report(frame, schema).withColumn("camada", F.lit(layer))
        for layer, (frame, schema) in altered.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def dimension_quality_report(spark, sf_dir):
    """The dimension with a row per supplier: codes repeat, and some names are missing."""
    suppliers = views.table(spark, sf_dir, "supplier").join(
        layers.read_dimension(spark, folders.dimension(spark, sf_dir)),
        F.col("s_nationkey").cast("string") == F.col("codigo_ibge"),
    )
    name = F.when(F.col("s_acctbal") >= 0, F.col("municipio"))
    return quality.dimension_report(
        suppliers.withColumn("municipio", name).select(DIMENSION.fieldNames())
    )


# --- Profiling --------------------------------------------------------------------------------


@query
def key_collisions(spark, sf_dir):
    return views.plain_names(profiling.key_collisions(views.raw(observed(spark, sf_dir))))


@query
def profile_exact_duplicates(spark, sf_dir):
    return profiling.exact_duplicates(views.raw(observed(spark, sf_dir)), reread=True)


@query
def profile_blank_rows(spark, sf_dir):
    return profiling.blank_rows(views.raw(observed(spark, sf_dir)))


@query
def profile_null_counts(spark, sf_dir):
    return profiling.null_counts(views.plain_names(views.raw(observed(spark, sf_dir))))


@query
def partition_profile(spark, sf_dir):
    found = profiling.partition_profile(views.raw(observed(spark, sf_dir)), reread=True)

    def joined(column: str):
        return F.array_join(column, "|", "(null)").alias(column)

    return found.select(
        *PARTITION,
        "total_linhas",
        "total_colunas",
        "data_minima",
        "data_maxima",
        "datas_ilegiveis",
        joined("produtos"),
        joined("unidades_de_medida"),
        "colisoes_chave_candidata",
        "duplicatas_exatas",
        "linhas_vazias",
        F.col("nulos")["Complemento"].alias("nulos_complemento"),
        F.size("nulos").alias("colunas_com_nulos"),
        joined("colunas"),
    )


@query
def bronze_profile(spark, sf_dir):
    """The profile of the raw files, whose headers differ by year."""
    found = profile.profile_bronze(spark, folders.bronze(spark, sf_dir))
    return found.select(
        *PARTITION,
        "total_linhas",
        "total_colunas",
        "data_minima",
        "data_maxima",
        "datas_ilegiveis",
        "colisoes_chave_candidata",
        "duplicatas_exatas",
        "linhas_vazias",
        F.size("nulos").alias("colunas_com_nulos"),
        F.array_contains("colunas", "Bandeira").alias("tem_bandeira"),
    )


@query
def bronze_values(spark, sf_dir):
    """Every product, unit and date of the raw files, with its rows."""
    return profile.bronze_values(spark, folders.bronze(spark, sf_dir))


# --- Files and whole jobs ---------------------------------------------------------------------


@query
def malformed_rows(spark, sf_dir):
    scanned = delimited.scan_bronze(spark, folders.surplus_bronze(spark, sf_dir), with_state=True)
    return delimited.malformed_rows(scanned)


@query
def landing_manifest(spark, sf_dir):
    """What two landings said of archives without a CSV, with one, with two, broken, and late."""
    runs = spark.read.parquet(f"{folders.landing_runs(spark, sf_dir)}/manifest")
    landed = (F.col("erro").isNull() & F.col("destino").isNotNull() & (F.col("bytes") > 0)).alias("landou")
    return runs.select(*PARTITION, "rodada", "membros_csv", landed).distinct()


@query
def missing_inputs(spark, sf_dir):
    """The layers of a chain that has not come to its second semesters and has no Gold."""
    gold = folders.first_halves(spark, sf_dir) + "-gold"
    return files.inputs_report(
        spark,
        {
            "bronze": (folders.bronze(spark, sf_dir), "*.csv"),
            "silver": (folders.first_halves(spark, sf_dir), layers.PARQUET),
            "silver_csv": (folders.first_halves(spark, sf_dir), "*.csv"),
            "gold": (gold, layers.PARQUET),
        },
    )


@query
def q5_view_chain(spark, sf_dir):
    """The parity by region in SQL: a view over the files, a query on it, its result as a view, a query on that."""
    layers.register_gold_view(spark, folders.direct_gold(spark, sf_dir), "precos_mensais")
    spark.sql(
        """SELECT e.ano_mes, e.codigo_ibge, e.regiao, e.uf,
          ROUND(e.preco_medio / g.preco_medio, 3) AS razao_etanol_gasolina
        FROM precos_mensais AS e INNER JOIN precos_mensais AS g
          ON e.ano_mes = g.ano_mes AND e.codigo_ibge = g.codigo_ibge
        WHERE e.produto = 'ETANOL' AND g.produto = 'GASOLINA'"""
    ).createOrReplaceTempView("q5_relacao_etanol_gasolina")
    return spark.sql(
        """SELECT regiao, COUNT(*) AS total, COUNT(*) FILTER (WHERE razao_etanol_gasolina < 0.70) AS abaixo_070,
          ROUND(100.0D * COUNT(*) FILTER (WHERE razao_etanol_gasolina < 0.70) / COUNT(*), 2) AS percentual_abaixo_070
        FROM q5_relacao_etanol_gasolina GROUP BY regiao ORDER BY percentual_abaixo_070 DESC"""
    )



@query
def csv_scan(spark, sf_dir):
    return views.plain_names(delimited.scan_bronze(spark, folders.bronze(spark, sf_dir)))


@query
def file_discovery(spark, sf_dir):
    """Folders of the discovered files (file names are the writer's own)."""
    found = files.discover(spark, folders.bronze(spark, sf_dir))
    folder = F.regexp_extract("path", "(ano=[^/]*/semestre=[^/]*)/[^/]*[.]csv$", 1)
    return found.select(folder.alias("pasta")).distinct()


@query
def partition_metadata(spark, sf_dir):
    found = files.partition_metadata(spark, folders.bronze(spark, sf_dir))
    return found.select(*PARTITION).distinct()


@query
def parquet_union_scan(spark, sf_dir):
    return comparable(layers.read_silver(spark, folders.silver(spark, sf_dir)))


@query
def parquet_sink_roundtrip(spark, sf_dir):
    written = layers.read_silver(spark, folders.direct_silver(spark, sf_dir), with_partition=True)
    return comparable(written.select(*SILVER.fieldNames(), *PARTITION))


@query
def gold_view(spark, sf_dir):
    view = layers.register_gold_view(spark, folders.direct_gold(spark, sf_dir))
    return rounded_deviation(view).select(*GOLD.fieldNames(), "ano")


@query
def gold_publish_yearly(spark, sf_dir):
    written = layers.read_gold(spark, folders.direct_gold(spark, sf_dir), with_year=True)
    return written.groupBy("ano").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.min("ano_mes").alias("primeira"),
        F.max("ano_mes").alias("ultima"),
        F.sum("qtd_coletas").alias("coletas"),
    )


@query
def bronze_to_silver(spark, sf_dir):
    written = layers.read_silver(spark, folders.silver(spark, sf_dir), with_partition=True)
    return comparable(written.select(*SILVER.fieldNames(), *PARTITION))


@query
def silver_to_gold(spark, sf_dir):
    return rounded_deviation(layers.read_gold(spark, folders.gold(spark, sf_dir)))


@query
def zip_landing(spark, sf_dir):
    return views.plain_names(delimited.scan_bronze(spark, folders.landed(spark, sf_dir)))


@query
def incremental_pending(spark, sf_dir):
    raw_files = files.partitions(spark, folders.bronze(spark, sf_dir), "*.csv")
    done = files.partitions(spark, folders.first_halves(spark, sf_dir), layers.PARQUET)
    return files.pending(raw_files, done).select(*PARTITION)


@query
def partition_coverage(spark, sf_dir):
    """Gaps from 1992, before the first observation, to 2003, after the last."""
    expected = files.expected_partitions(spark, range(1992, 2004))
    landed = files.partitions(spark, folders.bronze(spark, sf_dir), "*.csv")
    return files.coverage_gaps(expected, landed)
