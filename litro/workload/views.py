"""Test tables in the shape of each layer.

A line item is a price observation, its supplier the retailer, the supplier's nation the
municipality and the part type the product. Defects come from the rows' own attributes: the whole
tables are always used, and rows are only added or altered, never left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.functions.values import named
from litro.schemas import GOLD, GOLD_KEYS, PARTITION, RAW_HEADINGS, SILVER, SILVER_NAME_OF_HEADING

# Region -> (initials, official name, states of its lower and higher nation keys).
REGION = {
    "AFRICA": ("N", "Norte", "AM", "PA"),
    "AMERICA": ("NE", "Nordeste", "BA", "PE"),
    "ASIA": ("CO", "Centro-Oeste", "GO", "MT"),
    "EUROPE": ("SE", "Sudeste", "MG", "SP"),
    "MIDDLE EAST": ("S", "Sul", "PR", "RS"),
}
PRODUCT = {
    "ECONOMY": "ETANOL",
    "LARGE": "DIESEL",
    "MEDIUM": "DIESEL S10",
    "PROMO": "GASOLINA ADITIVADA",
    "SMALL": "GNV",
    "STANDARD": "GASOLINA",
}
# Silver-style names of the raw columns Silver drops.
DROPPED = {
    "Nome da Rua": "nome_rua",
    "Numero Rua": "numero_rua",
    "Complemento": "complemento",
    "Bairro": "bairro",
    "Valor de Compra": "valor_compra",
}
PLAIN_NAME = SILVER_NAME_OF_HEADING | DROPPED
HELPERS = ("l_linenumber", "l_quantity", "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(key: Column, mapping: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for value, result in mapping.items():
        out = F.when(key == value, F.lit(result)).otherwise(out)
    return out


def region_field(i: int) -> Column:
    return lookup(F.col("r_name"), {name: fields[i] for name, fields in REGION.items()})


def place() -> list[Column]:
    """Columns of a municipality, from `nations` and `regions`."""
    state = F.when(F.col("n_nationkey") < 13, F.col("lower_uf")).otherwise(F.col("higher_uf"))
    names = ("codigo_ibge", "municipio", "municipio_oficial", "regiao", "regiao_oficial")
    return [*[F.col(name) for name in names], state.alias("uf")]


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as municipalities; the official spelling only matches after folding."""
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        "n_regionkey",
        F.col("n_name").alias("municipio"),
        F.replace("n_name", F.lit("NATION_"), F.lit("Natióñ-")).alias("municipio_oficial"),
        F.col("n_nationkey").cast("string").alias("codigo_ibge"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("regiao", "regiao_oficial", "lower_uf", "higher_uf")
    fields = [region_field(i).alias(name) for i, name in enumerate(names)]
    return table(spark, sf_dir, "region").select("r_regionkey", *fields)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        nations(spark, sf_dir)
        .join(regions(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", *place())
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, clean and matched: everything the layers are cut from. Joins carry no hints; the
    tables' sizes decide between broadcast and shuffle. The largest table is joined first, while rows are
    narrow, and each table on its own, as the size of a join of tables is not known beforehand. Values are
    spelt in the small tables, not once a line item."""
    day = F.col("l_shipdate").cast("date")
    parts = table(spark, sf_dir, "part").select("p_partkey", lookup(F.col("p_type"), PRODUCT).alias("produto"), "p_brand")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            *place(),
            F.col("s_name").alias("revenda"),
            F.lpad(F.col("l_suppkey").cast("string"), 14, "0").alias("cnpj_revenda"),
            F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("cep"),
            "produto",
            day.alias("data_coleta"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("valor_venda"),
            F.when(F.col("produto") == PRODUCT["SMALL"], "R$ / m³").otherwise("R$ / litro").alias(
                "unidade_medida"
            ),
            F.col("p_brand").alias("bandeira"),
            F.year(day).alias("ano"),
            F.when(F.month(day) <= 6, 1).otherwise(2).alias("semestre"),
            *HELPERS,
        )
    )


def silver(obs: DataFrame) -> DataFrame:
    return obs.select(*SILVER.fieldNames(), *PARTITION)


def enriched(obs: DataFrame) -> DataFrame:
    official = {"municipio": "municipio_oficial", "regiao": "regiao_oficial"}
    return obs.select(
        "data_coleta",
        "valor_venda",
        *[F.col(official.get(c, c)).alias(c) for c in GOLD_KEYS if c != "ano_mes"],
    )


def misspelt(obs: DataFrame) -> DataFrame:
    """Silver rows, some with a municipality name no official list has."""
    name = F.when(F.col("l_quantity") == 7, F.concat(F.lit("VILA "), "municipio")).otherwise(
        F.col("municipio")
    )
    return obs.withColumn("municipio", name).select(*SILVER.fieldNames(), *PARTITION)


def faulty(obs: DataFrame) -> DataFrame:
    """Silver rows with one kind of fault for each of six quantities."""
    quantity = F.col("l_quantity")
    price = F.col("valor_venda")
    return (
        obs
        .withColumns(
            {
                "valor_venda": F.when(quantity == 1, None)
                .when(quantity == 2, -price)
                .otherwise(price)
                .cast("decimal(10,2)"),
                "cnpj_revenda": F.when(quantity == 3, F.substring("cnpj_revenda", 1, 13)).otherwise(
                    F.col("cnpj_revenda")
                ),
                "produto": F.when(quantity == 4, "QUEROSENE").otherwise(F.col("produto")),
                "uf": F.when(quantity == 5, "ZZ").otherwise(F.col("uf")),
                "unidade_medida": F.when(quantity == 6, None).otherwise(F.col("unidade_medida")),
            }
        )
        .select(*SILVER.fieldNames(), *PARTITION)
    )


def raw(obs: DataFrame) -> DataFrame:
    """Bronze text under the source's headings, with exact copies and blank rows added, all in one scan."""
    cnpj, cep = F.col("cnpj_revenda"), F.col("cep")
    old_unit = (F.col("unidade_medida") == "R$ / m³") & (F.col("l_linenumber") > 3)
    text = {
        "Regiao - Sigla": F.col("regiao"),
        "Estado - Sigla": F.col("uf"),
        "Municipio": F.col("municipio"),
        "Revenda": F.col("revenda"),
        "CNPJ da Revenda": F.concat(
            *[cnpj.substr(1, 2), F.lit("."), cnpj.substr(3, 3), F.lit("."), cnpj.substr(6, 3)],
            *[F.lit("/"), cnpj.substr(9, 4), F.lit("-"), cnpj.substr(13, 2)],
        ),
        "Nome da Rua": F.concat(F.lit("RUA "), cep),
        "Numero Rua": F.nullif(F.col("l_linenumber").cast("string"), F.lit("7")),
        "Complemento": F.when(F.col("l_linenumber") == 1, "LOJA A"),
        "Bairro": F.col("bandeira"),
        "Cep": F.concat(
            *[cep.substr(1, 2), F.lit("."), cep.substr(3, 3), F.lit("-"), cep.substr(6, 3)]
        ),
        "Produto": F.col("produto"),
        "Data da Coleta": F.date_format("data_coleta", "dd/MM/yyyy"),
        "Valor de Venda": F.replace(F.col("valor_venda").cast("string"), F.lit("."), F.lit(",")),
        "Valor de Compra": F.lit(None).cast("string"),
        "Unidade de Medida": F.when(old_unit, "R$ / m3").otherwise(F.col("unidade_medida")),
        "Bandeira": F.col("bandeira"),
    }
    copy = F.when(F.col("l_quantity") == 50, F.lit(False))
    blank = F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit(True))
    rows = obs.withColumn("blank", F.explode(F.array(F.lit(False), copy, blank))).where("blank IS NOT NULL")
    return rows.select(*[F.when(~F.col("blank"), text[h]).alias(h) for h in RAW_HEADINGS], *PARTITION)


def plain_names(df: DataFrame) -> DataFrame:
    """Raw columns under snake-case names, unknown ones unchanged."""
    return df.select(*[named(c).alias(PLAIN_NAME.get(c, c)) for c in df.columns])


def municipality_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records as the official list has them."""
    region = F.struct(F.col("regiao_oficial").alias("nome"))
    state = F.struct(F.col("uf").alias("sigla"), region.alias("regiao"))
    middle = F.struct(F.struct(state.alias("UF")).alias("regiao-intermediaria"))
    return places(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("municipio_oficial").alias("nome"),
        middle.alias("regiao-imediata"),
    )


#: Lines of a raw file of `surplus_bronze`.
LINES_OF_A_FILE = 2_000


def observed_lines(obs: DataFrame) -> DataFrame:
    """(ano, semestre, line_group, line): a raw line of sixteen fields for each observation, as hexadecimal bytes,
    some of them spoilt by quantity."""
    text = [F.col("uf"), F.col("municipio"), F.col("revenda"), F.col("cnpj_revenda"), F.col("produto"), F.col("l_linenumber").cast("string")]
    line = F.concat_ws(";", *text, *[F.lit(f"c{i}") for i in range(len(text), len(RAW_HEADINGS))])
    quantity = F.col("l_quantity")
    spoilt = (
        F.when(quantity == 1, F.concat(line, F.lit(";x")))
        .when(quantity == 2, F.concat(line, F.lit(";")))
        .when(quantity == 3, F.concat(F.lit('"a;b;"'), line))
        .when(quantity == 4, F.concat(line.substr(F.lit(1), F.length(line) - 3), F.lit('"c;15;16;17')))
        .when(quantity == 5, F.concat(F.lit('a"b;c"'), line))
        .otherwise(line)
    )
    encoded = F.hex(F.encode(spoilt, "UTF-8"))
    encoded = F.when(quantity == 6, F.concat(F.lit("C378"), encoded)).otherwise(encoded)
    group = F.pmod(F.xxhash64("cnpj_revenda", "cep", "data_coleta", "valor_venda"), F.lit(1 << 20))
    # A row per semester: no semester is sorted in one task to learn its size.
    files = F.ceil(F.count(F.lit(1)) / LINES_OF_A_FILE).alias("files")
    sizes = obs.groupBy(*[F.col(c).alias(f"of_{c}") for c in PARTITION]).agg(files)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in PARTITION]
    return obs.join(F.broadcast(sizes), same).select(
        *PARTITION, F.pmod(group, F.col("files")).alias("line_group"), encoded.alias("line")
    )


def doubtful(gold: DataFrame) -> DataFrame:
    """Gold stacked with its single-observation rows, whose metrics and code are spoilt."""
    single = gold.where("qtd_coletas = 1").withColumns(
        {
            "codigo_ibge": F.when(F.month("ano_mes") == 1, None).otherwise(F.col("codigo_ibge")),
            "preco_minimo": F.when(F.month("ano_mes") == 2, F.col("preco_maximo") + 1).otherwise(
                F.col("preco_minimo")
            ),
            "preco_medio": F.when(F.month("ano_mes") == 3, -F.col("preco_medio")).otherwise(
                F.col("preco_medio")
            ),
        }
    )
    return gold.unionByName(single)


def altered_silver(obs: DataFrame) -> DataFrame:
    """Silver rows that break the contract: a column dropped, one added, two retyped, one moved."""
    price = F.when(F.col("l_quantity") == 1, "x").otherwise(F.col("valor_venda").cast("string"))
    names = [c for c in SILVER.fieldNames() if c not in ("cep", "uf")]
    altered = obs.withColumns({"valor_venda": price, "data_coleta": F.col("data_coleta").cast("timestamp")})
    extra = F.when(F.col("l_quantity") == 2, F.lit(1)).alias("extra")
    return altered.select(*names, extra, "uf")


def altered_gold(gold: DataFrame) -> DataFrame:
    """Gold without the median, counts as text, and the first column last."""
    names = [c for c in GOLD.fieldNames() if c not in ("preco_mediano", "ano_mes")]
    counts = F.when(F.col("qtd_coletas") > 1, F.col("qtd_coletas").cast("string")).otherwise("uma")
    return gold.withColumn("qtd_coletas", counts).select(*names, "ano_mes")
