"""Independent SQL for every registered query, over the same tables."""

from __future__ import annotations

# Fixed values, spelled out here again so that a wrong list in the code they check is found.
PRODUCTS = ["DIESEL", "DIESEL S10", "ETANOL", "GASOLINA", "GASOLINA ADITIVADA", "GNV"]
UNITS = ["R$ / litro", "R$ / m³"]
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
REGIONS = ["Centro-Oeste", "Nordeste", "Norte", "Sudeste", "Sul"]
RAW_HEADINGS = [
    "Regiao - Sigla", "Estado - Sigla", "Municipio", "Revenda", "CNPJ da Revenda", "Nome da Rua", "Numero Rua", "Complemento",
    "Bairro", "Cep", "Produto", "Data da Coleta", "Valor de Venda", "Valor de Compra", "Unidade de Medida", "Bandeira",
]

OBS = """
place AS (
  SELECT n_nationkey, n_name AS municipio, replace(n_name, 'NATION_', 'Natióñ-') AS municipio_oficial,
    cast(n_nationkey AS varchar) AS codigo_ibge,
    CASE r_name WHEN 'AFRICA' THEN 'N' WHEN 'AMERICA' THEN 'NE' WHEN 'ASIA' THEN 'CO'
      WHEN 'EUROPE' THEN 'SE' WHEN 'MIDDLE EAST' THEN 'S' END AS regiao,
    CASE r_name WHEN 'AFRICA' THEN 'Norte' WHEN 'AMERICA' THEN 'Nordeste' WHEN 'ASIA' THEN 'Centro-Oeste'
      WHEN 'EUROPE' THEN 'Sudeste' WHEN 'MIDDLE EAST' THEN 'Sul' END AS regiao_oficial,
    CASE WHEN n_nationkey < 13 THEN CASE r_name WHEN 'AFRICA' THEN 'AM' WHEN 'AMERICA' THEN 'BA'
        WHEN 'ASIA' THEN 'GO' WHEN 'EUROPE' THEN 'MG' WHEN 'MIDDLE EAST' THEN 'PR' END
      ELSE CASE r_name WHEN 'AFRICA' THEN 'PA' WHEN 'AMERICA' THEN 'PE' WHEN 'ASIA' THEN 'MT'
        WHEN 'EUROPE' THEN 'SP' WHEN 'MIDDLE EAST' THEN 'RS' END END AS uf
  FROM nation JOIN region ON n_regionkey = r_regionkey),
obs AS (
  SELECT regiao, uf, municipio, s_name AS revenda, lpad(cast(l_suppkey AS varchar), 14, '0') AS cnpj_revenda,
    lpad(cast(l_partkey AS varchar), 8, '0') AS cep,
    CASE p_type WHEN 'ECONOMY' THEN 'ETANOL' WHEN 'LARGE' THEN 'DIESEL' WHEN 'MEDIUM' THEN 'DIESEL S10'
      WHEN 'PROMO' THEN 'GASOLINA ADITIVADA' WHEN 'SMALL' THEN 'GNV' WHEN 'STANDARD' THEN 'GASOLINA' END AS produto,
    cast(l_shipdate AS date) AS data_coleta, cast(l_extendedprice AS decimal(10,2)) AS valor_venda,
    CASE WHEN p_type = 'SMALL' THEN 'R$ / m³' ELSE 'R$ / litro' END AS unidade_medida, p_brand AS bandeira,
    codigo_ibge, municipio_oficial, regiao_oficial, cast(year(l_shipdate) AS int) AS ano,
    CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END AS semestre, l_linenumber, l_quantity, l_discount, l_tax
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN place ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

RAW_TEXT = """
  SELECT regiao, uf, municipio, revenda,
    concat(substr(cnpj_revenda,1,2),'.',substr(cnpj_revenda,3,3),'.',substr(cnpj_revenda,6,3),'/',
      substr(cnpj_revenda,9,4),'-',substr(cnpj_revenda,13,2)) AS cnpj_revenda,
    concat('RUA ', cep) AS nome_rua, nullif(cast(l_linenumber AS varchar), '7') AS numero_rua,
    CASE WHEN l_linenumber = 1 THEN 'LOJA A' END AS complemento, bandeira AS bairro,
    concat(substr(cep,1,2),'.',substr(cep,3,3),'-',substr(cep,6,3)) AS cep, produto,
    strftime(data_coleta, '%d/%m/%Y') AS data_coleta, replace(cast(valor_venda AS varchar),'.',',') AS valor_venda,
    cast(NULL AS varchar) AS valor_compra,
    CASE WHEN unidade_medida = 'R$ / m³' AND l_linenumber > 3 THEN 'R$ / m3' ELSE unidade_medida END AS unidade_medida,
    bandeira, ano, semestre"""

RAW_COLUMNS = (
    "regiao, uf, municipio, revenda, cnpj_revenda, nome_rua, numero_rua, complemento, bairro, cep, "
    "produto, data_coleta, valor_venda, valor_compra, unidade_medida, bandeira"
)

RAW = f"""{OBS},
raw AS ({RAW_TEXT} FROM obs
  UNION ALL {RAW_TEXT} FROM obs WHERE l_quantity = 50
  UNION ALL SELECT {"NULL, " * 16} ano, semestre FROM obs WHERE l_discount = 0 AND l_tax = 0)"""

CLEAN = f"""{RAW},
clean AS (SELECT regiao, uf, municipio, revenda, regexp_replace(cnpj_revenda, '[^0-9]', '', 'g') AS cnpj_revenda,
  regexp_replace(cep, '[^0-9]', '', 'g') AS cep, produto, cast(strptime(data_coleta, '%d/%m/%Y') AS date) AS data_coleta,
  cast(replace(valor_venda, ',', '.') AS decimal(10,2)) AS valor_venda,
  CASE WHEN unidade_medida = 'R$ / m3' THEN 'R$ / m³' ELSE unidade_medida END AS unidade_medida, bandeira, ano, semestre
  FROM (SELECT DISTINCT * FROM raw) WHERE coalesce({RAW_COLUMNS}) IS NOT NULL)"""

SILVER_COLUMNS = (
    "regiao, uf, municipio, revenda, cnpj_revenda, cep, produto, data_coleta, "
    "cast(valor_venda AS double) AS valor_venda, unidade_medida, bandeira"
)

STATISTICS = """
  cast(sum(valor_venda) AS double) / count(*) AS preco_medio, median(cast(valor_venda AS double)) AS preco_mediano,
  cast(min(valor_venda) AS double) AS preco_minimo, cast(max(valor_venda) AS double) AS preco_maximo,
  {deviation} AS desvio_padrao, count(*) AS qtd_coletas"""


def gold_cte(deviation: str = "stddev_samp(cast(valor_venda AS double))") -> str:
    return f"""{OBS},
gold AS (SELECT cast(date_trunc('month', data_coleta) AS date) AS ano_mes, codigo_ibge,
  municipio_oficial AS municipio, uf, regiao_oficial AS regiao, produto,
  {STATISTICS.format(deviation=deviation)} FROM obs GROUP BY 1, 2, 3, 4, 5, 6)"""


GOLD = gold_cte()
GOLD_ROUNDED = gold_cte("round(stddev_samp(cast(valor_venda AS double)), 6)")

FAULTY = f"""{OBS},
faulty AS (SELECT regiao, CASE WHEN l_quantity = 5 THEN 'ZZ' ELSE uf END AS uf, municipio, revenda,
  CASE WHEN l_quantity = 3 THEN substr(cnpj_revenda, 1, 13) ELSE cnpj_revenda END AS cnpj_revenda, cep,
  CASE WHEN l_quantity = 4 THEN 'QUEROSENE' ELSE produto END AS produto, data_coleta,
  CASE l_quantity WHEN 1 THEN NULL WHEN 2 THEN -valor_venda ELSE valor_venda END AS valor_venda,
  CASE WHEN l_quantity <> 6 THEN unidade_medida END AS unidade_medida, bandeira, ano, semestre FROM obs)"""

DOUBTFUL = f"""{GOLD},
doubtful AS (SELECT * FROM gold UNION ALL
  SELECT ano_mes, CASE WHEN month(ano_mes) <> 1 THEN codigo_ibge END, municipio, uf, regiao, produto,
    CASE WHEN month(ano_mes) = 3 THEN -preco_medio ELSE preco_medio END, preco_mediano,
    CASE WHEN month(ano_mes) = 2 THEN preco_maximo + 1 ELSE preco_minimo END, preco_maximo,
    desvio_padrao, qtd_coletas FROM gold WHERE qtd_coletas = 1)"""

MISSPELT = f"""{OBS},
misspelt AS (SELECT CASE WHEN l_quantity = 7 THEN 'VILA ' || municipio ELSE municipio END AS escrito, * FROM obs)"""

PARITY = f"""{GOLD},
parity AS (SELECT e.ano_mes, e.codigo_ibge, e.municipio, e.uf, e.regiao, e.preco_medio AS preco_etanol,
  g.preco_medio AS preco_gasolina, round(e.preco_medio / g.preco_medio, 3) AS razao_etanol_gasolina
  FROM gold e JOIN gold g ON e.ano_mes = g.ano_mes AND e.codigo_ibge = g.codigo_ibge
  WHERE e.produto = 'ETANOL' AND g.produto = 'GASOLINA')"""

SHARE = """count(*) AS total, count(*) FILTER (WHERE razao_etanol_gasolina < 0.70) AS abaixo_070,
  round(cast(100.0 * count(*) FILTER (WHERE razao_etanol_gasolina < 0.70) AS double) / count(*), 2)
    AS percentual_abaixo_070"""

# The amounts are summed as decimals. As doubles the sum depends on the order in which threads meet,
# and a mean that ends in exactly half a cent is then rounded up in one run and down in the next.
WEIGHTED = """round(cast(sum(cast(preco_medio * qtd_coletas AS decimal(28,6))) AS double)
    / sum(qtd_coletas), 2) AS preco_medio_ponderado,
  cast(sum(qtd_coletas) AS bigint) AS total_coletas"""


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def matrix(value: str) -> str:
    return ", ".join(f"""max(CASE WHEN regiao = '{r}' THEN {value} END) AS "{r}" """ for r in REGIONS)


def checks(source: str, rules: dict[str, str]) -> str:
    """One `SELECT check, violations` per rule."""
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", count(*) FILTER (WHERE {condition}) AS violations FROM {source}"
        for check, condition in rules.items()
    )


PRICE_RULE = {"price_positive": "valor_venda IS NULL OR valor_venda <= 0"}
SILVER_NULLS = {
    f"required_{c}": f"{c} IS NULL"
    for c in (
        "uf", "municipio", "cnpj_revenda", "produto", "data_coleta", "valor_venda", "unidade_medida",
    )
}
CNPJ_RULE = {"cnpj_format": "NOT regexp_full_match(cnpj_revenda, '[0-9]{14}')"}
SILVER_RULES = {
    **PRICE_RULE,
    "allowed_produto": f"produto NOT IN ({quoted(PRODUCTS)})",
    "allowed_unidade_medida": f"unidade_medida NOT IN ({quoted(UNITS)})",
    **SILVER_NULLS,
    **CNPJ_RULE,
    "allowed_uf": f"uf NOT IN ({quoted(STATES)})",
}
GOLD_NULLS = {
    f"required_{c}": f"{c} IS NULL"
    for c in (
        "ano_mes", "codigo_ibge", "municipio", "uf", "regiao", "produto", "preco_medio",
        "preco_mediano", "preco_minimo", "preco_maximo", "qtd_coletas",
    )
}
METRICS_RULE = {
    "metrics": "preco_medio <= 0 OR preco_mediano <= 0 OR preco_minimo <= 0 OR preco_maximo <= 0 "
    "OR preco_minimo > preco_maximo OR qtd_coletas <= 0"
}

FOLDED = "regexp_replace(upper(strip_accents(replace({}, 'ß', 'SS'))), '[^A-Z0-9 ]', '', 'g')"

DRIFTED = """CASE WHEN ano > 1996 THEN bandeira END AS bandeira"""
SCANNED = f"""SELECT {RAW_COLUMNS.removesuffix("bandeira")} {DRIFTED},
  CASE WHEN ano >= 2000 AND produto IS NOT NULL THEN 'coleta' END AS "Origem", ano, semestre FROM raw"""
SILVER_FROM_FILES = SILVER_COLUMNS.removesuffix("bandeira") + DRIFTED

EACH_PARTITION = "SELECT DISTINCT ano, semestre FROM obs"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


ORACLES: dict[str, str] = {
    "gold_monthly_prices": with_(GOLD_ROUNDED, "SELECT * FROM gold"),
    "gold_sorted": with_(GOLD_ROUNDED, "SELECT * FROM gold ORDER BY ano_mes, codigo_ibge, produto"),
    "gold_preview_topn": with_(
        GOLD_ROUNDED, "SELECT * FROM gold ORDER BY ano_mes, codigo_ibge, produto LIMIT 10"
    ),
    "overview_count": with_(GOLD, "SELECT count(*) AS quantidade_registros FROM gold"),
    "overview_summary": with_(
        GOLD,
        "SELECT min(ano_mes) AS primeira_competencia, max(ano_mes) AS ultima_competencia, "
        "count(DISTINCT codigo_ibge) AS municipios, count(DISTINCT produto) AS produtos FROM gold",
    ),
    "overview_by_product": with_(
        GOLD,
        "SELECT produto, count(*) AS registros, round(avg(preco_medio), 2) AS preco_medio "
        "FROM gold GROUP BY produto",
    ),
    "q1_region_product": with_(
        GOLD, f"SELECT regiao, produto, {WEIGHTED} FROM gold GROUP BY regiao, produto"
    ),
    "q1_region_year": with_(
        GOLD,
        f"SELECT cast(year(ano_mes) AS int) AS ano, regiao, produto, {WEIGHTED} FROM gold GROUP BY 1, 2, 3",
    ),
    "q1_gasoline_year": with_(
        GOLD,
        f"SELECT cast(year(ano_mes) AS int) AS ano, regiao, produto, {WEIGHTED} FROM gold "
        "WHERE produto = 'GASOLINA' GROUP BY 1, 2, 3",
    ),
    "q1_pivot": with_(
        f"{GOLD}, q AS (SELECT regiao, produto, {WEIGHTED} FROM gold GROUP BY regiao, produto)",
        f"SELECT produto, {matrix('preco_medio_ponderado')} FROM q GROUP BY produto",
    ),
    "q4_dispersion": with_(
        GOLD,
        "SELECT regiao, produto, round(avg(desvio_padrao), 3) AS desvio_padrao_medio, "
        "count(desvio_padrao) AS total_municipios_mes FROM gold WHERE desvio_padrao IS NOT NULL "
        "GROUP BY regiao, produto",
    ),
    "q4_pivot": with_(
        f"{GOLD}, q AS (SELECT regiao, produto, round(avg(desvio_padrao), 3) AS v FROM gold "
        "WHERE desvio_padrao IS NOT NULL GROUP BY regiao, produto)",
        f"SELECT produto, {matrix('v')} FROM q GROUP BY produto",
    ),
    "q5_ratio": with_(PARITY, "SELECT * FROM parity"),
    "q5_summary": with_(PARITY, f"SELECT {SHARE} FROM parity"),
    "q5_by_region": with_(PARITY, f"SELECT regiao, {SHARE} FROM parity GROUP BY regiao"),
    "q5_by_state": with_(PARITY, f"SELECT uf, regiao, {SHARE} FROM parity GROUP BY uf, regiao"),
    "decimal_comma": with_(
        f"{RAW}, t AS (SELECT CASE WHEN valor_venda IS NOT NULL AND numero_rua IS NOT NULL "
        "THEN valor_venda || ',' || numero_rua END AS entrada FROM raw)",
        "SELECT entrada, regexp_replace(entrada, ',', '.') AS saida FROM t",
    ),
    "digits_only": with_(
        RAW,
        "SELECT regexp_replace(cnpj_revenda, '[^0-9]', '', 'g') AS cnpj_revenda, "
        "regexp_replace(cep, '[^0-9]', '', 'g') AS cep FROM raw",
    ),
    "date_parse": with_(
        RAW,
        "SELECT data_coleta AS texto, cast(strptime(data_coleta, '%d/%m/%Y') AS date) AS data_coleta FROM raw",
    ),
    "decimal_cast": with_(
        RAW,
        "SELECT valor_venda AS texto, cast(cast(replace(valor_venda, ',', '.') AS decimal(10,2)) AS double) "
        "AS valor_venda FROM raw",
    ),
    "unit_normalize": with_(
        RAW,
        "SELECT unidade_medida AS original, CASE WHEN unidade_medida = 'R$ / m3' THEN 'R$ / m³' "
        "ELSE unidade_medida END AS unidade_medida, count(*) AS linhas FROM raw GROUP BY 1, 2",
    ),
    "month_trunc": with_(
        OBS,
        "SELECT cast(date_trunc('month', data_coleta) AS date) AS ano_mes, count(*) AS linhas FROM obs GROUP BY 1",
    ),
    "text_fold": f"SELECT doc_id, {FOLDED.format('text')} AS chave FROM documents",
    "text_fold_udf": f"SELECT doc_id, {FOLDED.format('text')} AS chave FROM documents",
    "max_decimal_places": with_(
        OBS,
        "SELECT cast(max(coalesce(length(string_split(cast(valor_venda AS varchar), '.')[2]), 0)) AS int) "
        "AS maximo_casas_decimais FROM obs",
    ),
    "struct_path": with_(
        OBS, "SELECT cast(n_nationkey AS bigint) AS id, uf, regiao_oficial AS regiao FROM place"
    ),
    "select_rename": with_(
        RAW,
        "SELECT regiao, uf, municipio, revenda, cnpj_revenda, cep, produto, data_coleta, valor_venda, "
        "unidade_medida, bandeira, ano, semestre FROM raw",
    ),
    "optional_columns": with_(
        RAW,
        "SELECT regiao, uf, municipio, revenda, cnpj_revenda, cast(NULL AS varchar) AS cep, produto, data_coleta, "
        "valor_venda, unidade_medida, cast(NULL AS varchar) AS bandeira, ano, semestre FROM raw",
    ),
    "drop_blank_rows": with_(RAW, f"SELECT * FROM raw WHERE coalesce({RAW_COLUMNS}) IS NOT NULL"),
    "exact_dedup": with_(RAW, "SELECT DISTINCT * FROM raw"),
    "silver_transform": with_(CLEAN, f"SELECT {SILVER_COLUMNS}, ano, semestre FROM clean"),
    "distinct_values": with_(
        RAW, "SELECT DISTINCT unidade_medida AS valor FROM raw WHERE unidade_medida IS NOT NULL"
    ),
    "distinct_sorted": with_(
        RAW, "SELECT DISTINCT produto AS valor FROM raw ORDER BY valor NULLS FIRST"
    ),
    "union_all": with_(
        FAULTY,
        f"SELECT {SILVER_COLUMNS}, ano, semestre FROM obs UNION ALL "
        f"SELECT {SILVER_COLUMNS}, ano, semestre FROM faulty",
    ),
    "municipality_dimension": with_(
        OBS,
        "SELECT codigo_ibge, municipio_oficial AS municipio, uf, regiao_oficial AS regiao, "
        f"{FOLDED.format('municipio_oficial')} AS municipio_match FROM place",
    ),
    "json_nested_scan": with_(
        OBS,
        "SELECT cast(n_nationkey AS bigint) AS id, municipio_oficial AS nome, uf AS sigla, "
        "regiao_oficial AS regiao FROM place",
    ),
    "enrich_municipality": with_(
        f"""{MISSPELT}, dimension AS (SELECT codigo_ibge AS code, municipio_oficial AS name,
          uf AS state, regiao_oficial AS region, {FOLDED.format("municipio_oficial")} AS match FROM place)""",
        "SELECT uf, revenda, cnpj_revenda, cep, produto, data_coleta, cast(valor_venda AS double) AS valor_venda, "
        "unidade_medida, bandeira, code AS codigo_ibge, name AS municipio, region AS regiao FROM misspelt "
        f"LEFT JOIN dimension ON uf = state AND {FOLDED.format('escrito')} = match",
    ),
    "unmatched_municipalities": with_(
        OBS,
        "SELECT ano, semestre, count(*) AS linhas, count(*) FILTER (WHERE l_quantity = 7) AS sem_codigo "
        "FROM obs GROUP BY 1, 2",
    ),
    "check_join_key_unique": with_(
        OBS,
        f"SELECT uf, {FOLDED.format('municipio_oficial')} AS municipio_match, count(*) AS quantidade "
        "FROM customer JOIN place ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "schema_drift": with_(
        OBS,
        f"""SELECT ano, semestre, 'Produto' AS coluna, 'missing critical' AS problema FROM ({EACH_PARTITION})
        UNION ALL SELECT ano, semestre, 'Origem', 'unknown' FROM ({EACH_PARTITION}) WHERE ano >= 2000""",
    ),
    "check_price_positive": with_(
        FAULTY,
        "SELECT ano, semestre, 'price_positive' AS \"check\", count(*) FILTER "
        f"(WHERE {PRICE_RULE['price_positive']}) AS violations FROM faulty GROUP BY 1, 2",
    ),
    "check_required": with_(FAULTY, checks("faulty", SILVER_NULLS)),
    "check_cnpj": with_(
        FAULTY,
        "SELECT ano, semestre, 'cnpj_format' AS \"check\", count(*) FILTER "
        f"(WHERE {CNPJ_RULE['cnpj_format']}) AS violations FROM faulty GROUP BY 1, 2",
    ),
    "check_allowed_values": with_(
        FAULTY,
        f"""SELECT 'produto' AS coluna, produto AS valor, count(*) AS linhas FROM faulty
          WHERE produto NOT IN ({quoted(PRODUCTS)}) GROUP BY 2
        UNION ALL SELECT 'unidade_medida', unidade_medida, count(*) FROM faulty
          WHERE unidade_medida NOT IN ({quoted(UNITS)}) GROUP BY 2
        UNION ALL SELECT 'uf', uf, count(*) FROM faulty WHERE uf NOT IN ({quoted(STATES)}) GROUP BY 2""",
    ),
    "silver_quality_report": with_(FAULTY, checks("faulty", SILVER_RULES)),
    "check_gold_grain": with_(
        DOUBTFUL,
        "SELECT ano_mes, codigo_ibge, produto, count(*) AS quantidade FROM doubtful GROUP BY 1, 2, 3 "
        "HAVING count(*) > 1",
    ),
    "check_gold_required": with_(DOUBTFUL, checks("doubtful", GOLD_NULLS)),
    "check_gold_metrics": with_(DOUBTFUL, checks("doubtful", METRICS_RULE)),
    "gold_quality_report": with_(
        DOUBTFUL,
        "SELECT 'grain' AS \"check\", count(*) AS violations FROM (SELECT 1 FROM doubtful "
        "GROUP BY ano_mes, codigo_ibge, produto HAVING count(*) > 1) UNION ALL "
        + checks("doubtful", GOLD_NULLS | METRICS_RULE),
    ),
    "dimension_quality_report": with_(
        f"{OBS}, listed AS (SELECT codigo_ibge, CASE WHEN s_acctbal >= 0 THEN municipio_oficial END AS municipio, "
        "uf, regiao_oficial AS regiao, municipio AS municipio_match FROM supplier JOIN place ON s_nationkey = n_nationkey)",
        "SELECT 'not_empty' AS \"check\", cast(count(*) = 0 AS bigint) AS violations FROM listed UNION ALL "
        + checks(
            "listed",
            {
                f"required_{c}": f"{c} IS NULL"
                for c in ("codigo_ibge", "municipio", "uf", "regiao", "municipio_match")
            },
        )
        + " UNION ALL SELECT 'unique_codigo_ibge', count(*) FROM (SELECT 1 FROM listed GROUP BY codigo_ibge "
        "HAVING count(*) > 1)",
    ),
    "key_collisions": with_(
        RAW,
        "SELECT ano, semestre, cnpj_revenda, produto, data_coleta, count(*) AS quantidade FROM raw "
        "WHERE cnpj_revenda IS NOT NULL AND produto IS NOT NULL AND data_coleta IS NOT NULL "
        "GROUP BY ALL HAVING count(*) > 1",
    ),
    "profile_exact_duplicates": with_(
        RAW,
        "SELECT ano, semestre, cast(sum(n) - count(*) AS bigint) AS duplicatas_exatas FROM "
        f"(SELECT {RAW_COLUMNS}, ano, semestre, count(*) AS n FROM raw GROUP BY ALL) GROUP BY 1, 2",
    ),
    "profile_blank_rows": with_(
        RAW,
        "SELECT ano, semestre, count(*) FILTER (WHERE municipio IS NULL) AS linhas_vazias FROM raw GROUP BY 1, 2",
    ),
    "profile_null_counts": with_(
        RAW,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT ano, semestre, '{c}' AS coluna, count(*) FILTER (WHERE {c} IS NULL) AS nulos "
            "FROM raw GROUP BY 1, 2"
            for c in RAW_COLUMNS.split(", ")
        )
        + ") WHERE nulos > 0",
    ),
    "partition_profile": with_(
        f"""{RAW},
        size AS (SELECT ano, semestre, count(*) AS total_linhas, cast(16 AS bigint) AS total_colunas,
          min(cast(strptime(data_coleta, '%d/%m/%Y') AS date)) AS data_minima,
          max(cast(strptime(data_coleta, '%d/%m/%Y') AS date)) AS data_maxima,
          count(data_coleta) - count(try_strptime(data_coleta, '%d/%m/%Y')) AS datas_ilegiveis,
          CASE WHEN count(*) > count(produto) THEN '(null)|' ELSE '' END
            || string_agg(DISTINCT produto, '|' ORDER BY produto) AS produtos,
          CASE WHEN count(*) > count(unidade_medida) THEN '(null)|' ELSE '' END
            || string_agg(DISTINCT unidade_medida, '|' ORDER BY unidade_medida) AS unidades_de_medida,
          count(*) FILTER (WHERE municipio IS NULL) AS linhas_vazias,
          count(*) - count(complemento) AS nulos_complemento,
          cast({" + ".join(f"cast(count(*) > count({c}) AS int)" for c in RAW_COLUMNS.split(", "))} AS int)
            AS colunas_com_nulos
          FROM raw GROUP BY 1, 2),
        collision AS (SELECT ano, semestre, count(*) AS colisoes FROM (SELECT ano, semestre FROM raw
          WHERE cnpj_revenda IS NOT NULL GROUP BY ano, semestre, cnpj_revenda, produto, data_coleta
          HAVING count(*) > 1) GROUP BY 1, 2),
        copy AS (SELECT ano, semestre, count(*) AS linhas FROM (SELECT DISTINCT * FROM raw) GROUP BY 1, 2)""",
        f"""SELECT size.*, coalesce(colisoes, 0) AS colisoes_chave_candidata,
          total_linhas - linhas AS duplicatas_exatas, '{"|".join(RAW_HEADINGS)}' AS colunas
        FROM size JOIN copy USING (ano, semestre) LEFT JOIN collision USING (ano, semestre)""",
    ),
    "bronze_profile": with_(
        f"""{RAW},
        size AS (SELECT ano, semestre, count(*) AS total_linhas,
          min(cast(strptime(data_coleta, '%d/%m/%Y') AS date)) AS data_minima,
          max(cast(strptime(data_coleta, '%d/%m/%Y') AS date)) AS data_maxima,
          count(data_coleta) - count(try_strptime(data_coleta, '%d/%m/%Y')) AS datas_ilegiveis,
          count(*) FILTER (WHERE municipio IS NULL) AS linhas_vazias,
          {" + ".join(f"cast(count(*) > count({c}) AS int)" for c in RAW_COLUMNS.split(", "))} AS com_nulos,
          cast(count(*) > count(bandeira) AS int) AS bandeira_com_nulos
          FROM raw GROUP BY 1, 2),
        collision AS (SELECT ano, semestre, count(*) AS colisoes FROM (SELECT ano, semestre FROM raw
          WHERE cnpj_revenda IS NOT NULL GROUP BY ano, semestre, cnpj_revenda, produto, data_coleta
          HAVING count(*) > 1) GROUP BY 1, 2),
        copy AS (SELECT ano, semestre, count(*) AS linhas FROM (SELECT DISTINCT * FROM raw) GROUP BY 1, 2)""",
        """SELECT ano, semestre, total_linhas,
          cast(CASE WHEN ano <= 1996 THEN 15 WHEN ano < 2000 THEN 16 ELSE 17 END AS bigint) AS total_colunas,
          data_minima, data_maxima, datas_ilegiveis, coalesce(colisoes, 0) AS colisoes_chave_candidata,
          total_linhas - linhas AS duplicatas_exatas, linhas_vazias,
          cast(com_nulos - CASE WHEN ano <= 1996 THEN bandeira_com_nulos ELSE 0 END
            + CASE WHEN ano >= 2000 AND linhas_vazias > 0 THEN 1 ELSE 0 END AS int) AS colunas_com_nulos,
          ano > 1996 AS tem_bandeira
        FROM size JOIN copy USING (ano, semestre) LEFT JOIN collision USING (ano, semestre)""",
    ),
    "gold_published_report": with_(
        f"""{DOUBTFUL}, filed AS (SELECT *, cast(year(ano_mes) AS int) AS ano,
          count(*) OVER (PARTITION BY ano_mes, codigo_ibge, produto) AS same FROM doubtful)""",
        " UNION ALL ".join(
            f"SELECT ano, '{check}' AS \"check\", count(*) AS linhas, count(*) FILTER (WHERE {condition}) AS violations "
            "FROM filed GROUP BY ano"
            for check, condition in (GOLD_NULLS | METRICS_RULE | {"folder": "false", "grain": "same > 1"}).items()
        ),
    ),
    "contract_report": with_(
        GOLD,
        """SELECT * FROM (
          SELECT 1 AS ordem, 'uf' AS coluna, 'posição' AS problema, 'string' AS tipo_esperado, 'string' AS tipo_encontrado,
            2 AS posicao_esperada, 11 AS posicao_encontrada, (SELECT count(uf) FROM obs) AS valores, NULL::bigint AS incompativeis, 'silver' AS camada
          UNION ALL SELECT 2, 'cep', 'ausente', 'string', NULL, 6, NULL, NULL, NULL, 'silver'
          UNION ALL SELECT 3, 'data_coleta', 'tipo', 'date', 'timestamp', 8, 6, (SELECT count(data_coleta) FROM obs), 0, 'silver'
          UNION ALL SELECT 4, 'valor_venda', 'tipo', 'decimal(10,2)', 'string', 9, 7, (SELECT count(valor_venda) FROM obs),
            (SELECT count(*) FROM obs WHERE l_quantity = 1), 'silver'
          UNION ALL SELECT 5, 'extra', 'inesperada', NULL, 'int', NULL, 10, (SELECT count(*) FROM obs WHERE l_quantity = 2), NULL, 'silver'
          UNION ALL SELECT 1, 'ano_mes', 'posição', 'date', 'date', 1, 11, (SELECT count(ano_mes) FROM gold), NULL, 'gold'
          UNION ALL SELECT 2, 'preco_mediano', 'ausente', 'double', NULL, 8, NULL, NULL, NULL, 'gold'
          UNION ALL SELECT 3, 'qtd_coletas', 'tipo', 'bigint', 'string', 12, 10, (SELECT count(qtd_coletas) FROM gold),
            (SELECT count(*) FROM gold WHERE qtd_coletas = 1), 'gold')""",
    ),
    "bronze_values": with_(
        RAW,
        " UNION ALL ".join(
            f"SELECT ano, semestre, '{heading}' AS coluna, {column} AS valor, count(*) AS n FROM raw GROUP BY ano, semestre, {column}"
            for heading, column in {"Produto": "produto", "Unidade de Medida": "unidade_medida", "Data da Coleta": "data_coleta"}.items()
        ),
    ),
    "malformed_rows": with_(
        OBS,
        "SELECT ano, semestre, count(*) FILTER (WHERE l_quantity IN (1, 2, 5)) AS campos_excedentes, "
        "count(*) FILTER (WHERE l_quantity = 6) AS bytes_invalidos FROM obs WHERE l_quantity IN (1, 2, 5, 6) GROUP BY 1, 2",
    ),
    "landing_manifest": with_(
        f"{OBS}, cases AS (SELECT ano, semestre, (2 * ano + semestre) % 5 AS kind FROM ({EACH_PARTITION}))",
        """SELECT ano, semestre, 1 AS rodada, CASE kind WHEN 0 THEN 0 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS membros_csv,
          kind IN (1, 4) AS landou FROM cases
        UNION ALL SELECT ano, semestre, 2, CASE kind WHEN 2 THEN 2 WHEN 4 THEN 1 ELSE 0 END, kind = 4 FROM cases WHERE kind <> 1""",
    ),
    "missing_inputs": with_(
        f"{OBS}, halves AS ({EACH_PARTITION})",
        """SELECT 'bronze' AS camada, true AS presente, count(*) AS particoes FROM halves
        UNION ALL SELECT 'silver', count(*) > 0, count(*) FROM halves WHERE semestre = 1
        UNION ALL SELECT 'silver_csv', false, 0 UNION ALL SELECT 'gold', false, 0""",
    ),
    "q5_view_chain": with_(PARITY, f"SELECT regiao, {SHARE} FROM parity GROUP BY regiao"),
    "csv_scan": with_(RAW, SCANNED),
    "file_discovery": with_(
        OBS, "SELECT DISTINCT 'ano=' || ano || '/semestre=' || semestre AS pasta FROM obs"
    ),
    "partition_metadata": with_(OBS, EACH_PARTITION),
    "parquet_union_scan": with_(CLEAN, f"SELECT {SILVER_FROM_FILES} FROM clean"),
    "parquet_sink_roundtrip": with_(
        OBS, f"SELECT {SILVER_COLUMNS}, ano, semestre FROM obs"
    ),
    "gold_view": with_(GOLD_ROUNDED, "SELECT *, cast(year(ano_mes) AS int) AS ano FROM gold"),
    "gold_publish_yearly": with_(
        GOLD,
        "SELECT cast(year(ano_mes) AS int) AS ano, count(*) AS linhas, min(ano_mes) AS primeira, "
        "max(ano_mes) AS ultima, cast(sum(qtd_coletas) AS bigint) AS coletas FROM gold GROUP BY 1",
    ),
    "bronze_to_silver": with_(CLEAN, f"SELECT {SILVER_FROM_FILES}, ano, semestre FROM clean"),
    "silver_to_gold": with_(GOLD_ROUNDED, "SELECT * FROM gold"),
    "zip_landing": with_(RAW, SCANNED),
    "incremental_pending": with_(
        OBS, f"SELECT * FROM ({EACH_PARTITION}) WHERE semestre = 2"
    ),
    "partition_coverage": with_(
        OBS,
        "SELECT cast(y AS int) AS ano, cast(s AS int) AS semestre FROM range(1992, 2004) AS years(y), "
        f"(VALUES (1), (2)) AS halves(s) EXCEPT {EACH_PARTITION}",
    ),
}
