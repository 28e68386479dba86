"""Layer contracts: headings, column mapping, types, required fields and allow-lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: headings, names, types and domains the results must agree on ----------------

RAW_HEADINGS = (
    "Regiao - Sigla",
    "Estado - Sigla",
    "Municipio",
    "Revenda",
    "CNPJ da Revenda",
    "Nome da Rua",
    "Numero Rua",
    "Complemento",
    "Bairro",
    "Cep",
    "Produto",
    "Data da Coleta",
    "Valor de Venda",
    "Valor de Compra",
    "Unidade de Medida",
    "Bandeira",
)

CRITICAL_HEADINGS = (
    "Estado - Sigla",
    "Municipio",
    "CNPJ da Revenda",
    "Produto",
    "Data da Coleta",
    "Valor de Venda",
    "Unidade de Medida",
)

OPTIONAL_HEADINGS = ("Regiao - Sigla", "Revenda", "Cep", "Bandeira")

SILVER_NAME_OF_HEADING = {
    "Regiao - Sigla": "regiao",
    "Estado - Sigla": "uf",
    "Municipio": "municipio",
    "Revenda": "revenda",
    "CNPJ da Revenda": "cnpj_revenda",
    "Cep": "cep",
    "Produto": "produto",
    "Data da Coleta": "data_coleta",
    "Valor de Venda": "valor_venda",
    "Unidade de Medida": "unidade_medida",
    "Bandeira": "bandeira",
}

PRODUCTS = ("DIESEL", "DIESEL S10", "ETANOL", "GASOLINA", "GASOLINA ADITIVADA", "GNV")

UNITS = ("R$ / litro", "R$ / m³")

STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

REGIONS = ("Centro-Oeste", "Nordeste", "Norte", "Sudeste", "Sul")

PRICE = T.DecimalType(10, 2)

SILVER = T.StructType(
    [
        T.StructField("regiao", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("revenda", T.StringType()),
        T.StructField("cnpj_revenda", T.StringType()),
        T.StructField("cep", T.StringType()),
        T.StructField("produto", T.StringType()),
        T.StructField("data_coleta", T.DateType()),
        T.StructField("valor_venda", PRICE),
        T.StructField("unidade_medida", T.StringType()),
        T.StructField("bandeira", T.StringType()),
    ]
)

SILVER_REQUIRED = (
    "uf",
    "municipio",
    "cnpj_revenda",
    "produto",
    "data_coleta",
    "valor_venda",
    "unidade_medida",
)

DIMENSION = T.StructType(
    [
        T.StructField("codigo_ibge", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("regiao", T.StringType()),
        T.StructField("municipio_match", T.StringType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("ano_mes", T.DateType()),
        T.StructField("codigo_ibge", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("regiao", T.StringType()),
        T.StructField("produto", T.StringType()),
        T.StructField("preco_medio", T.DoubleType()),
        T.StructField("preco_mediano", T.DoubleType()),
        T.StructField("preco_minimo", T.DoubleType()),
        T.StructField("preco_maximo", T.DoubleType()),
        T.StructField("desvio_padrao", T.DoubleType()),
        T.StructField("qtd_coletas", T.LongType()),
    ]
)

GOLD_REQUIRED = tuple(f for f in GOLD.fieldNames() if f != "desvio_padrao")

# --- End of fixed values ----------------------------------------------------------------------

PARTITION = ("ano", "semestre")
# What is wrong with a raw line, and a number that keeps such lines apart; null for lines in order.
STATE, ROW = "_estado", "_linha"
# Where what a row says has its bit in the map of copies, see `operators/copies`.
PLACE = "_lugar"
GOLD_KEYS = ("ano_mes", "codigo_ibge", "municipio", "uf", "regiao", "produto")
GOLD_GRAIN = ("ano_mes", "codigo_ibge", "produto")

# Only the paths the dimension needs; the payload's other fields are never parsed.
MUNICIPALITY_JSON = (
    "id bigint, nome string, `regiao-imediata` struct<`regiao-intermediaria`: "
    "struct<UF: struct<sigla: string, regiao: struct<nome: string>>>>"
)


def names_and_types(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """Schema without nullability, which files do not keep."""
    return [(f.name, f.dataType) for f in schema.fields]
