from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from litro.operators import profiling, quality
from litro.schemas import DIMENSION, GOLD, PARTITION, RAW_HEADINGS, SILVER

GOOD = (
    "S", "RS", "PORTO ALEGRE", "POSTO", "11222333000144", None, "GASOLINA", date(2024, 3, 7),
    Decimal("5.89"), "R$ / litro", None,
)


def silver(spark, *changes):
    names = SILVER.fieldNames()
    rows = [tuple((dict(zip(names, GOOD)) | change)[n] for n in names) for change in changes]
    return spark.createDataFrame(rows, SILVER)


def counts(report):
    return {r.check: r.violations for r in report.collect() if r.violations}


def test_good_rows_pass(spark):
    quality.validate_silver(silver(spark, {}, {"regiao": None, "revenda": None}))
    quality.validate_silver(silver(spark))


@pytest.mark.parametrize(
    ("change", "found"),
    [
        ({"valor_venda": Decimal("0.00")}, {"price_positive": 1}),
        ({"valor_venda": None}, {"price_positive": 1, "required_valor_venda": 1}),
        ({"produto": "QUEROSENE"}, {"allowed_produto": 1}),
        ({"produto": None}, {"required_produto": 1}),
        ({"unidade_medida": "R$ / m3"}, {"allowed_unidade_medida": 1}),
        ({"cnpj_revenda": "1122233300014"}, {"cnpj_format": 1}),
        ({"cnpj_revenda": "11222333000144\n"}, {"cnpj_format": 1}),
        ({"cnpj_revenda": None}, {"required_cnpj_revenda": 1}),
        ({"uf": "XX"}, {"allowed_uf": 1}),
        ({"uf": None}, {"required_uf": 1}),
        ({"data_coleta": None}, {"required_data_coleta": 1}),
        ({"municipio": None}, {"required_municipio": 1}),
    ],
)
def test_each_silver_rule(spark, change, found):
    df = silver(spark, {}, change)
    assert counts(quality.report(df, quality.silver_rules())) == found
    with pytest.raises(ValueError, match=next(iter(found))):
        quality.validate_silver(df)


def test_rules_are_enforced_in_order(spark):
    df = silver(spark, {"uf": "XX"}, {"produto": "QUEROSENE"}, {"cnpj_revenda": "1"})
    with pytest.raises(ValueError, match="1 rows violate allowed_produto"):
        quality.validate_silver(df)


def test_report_by_partition(spark):
    df = silver(spark, {"uf": "XX"}, {}).withColumns({"ano": F.lit(2024), "semestre": F.lit(2)})
    rows = quality.report(df, quality.silver_rules(), PARTITION).where("violations > 0").collect()
    assert [(r.ano, r.semestre, r.check, r.violations) for r in rows] == [(2024, 2, "allowed_uf", 1)]


def test_offending_values(spark):
    df = silver(spark, {"produto": "A"}, {"produto": "A", "uf": "ZZ"}, {}, {"produto": None})
    found = quality.offending_values(df, {"produto": quality.PRODUCTS, "uf": quality.STATES})
    assert {tuple(r) for r in found.collect()} == {("produto", "A", 2), ("uf", "ZZ", 1)}


def test_silver_columns_and_types(spark):
    df = silver(spark, {})
    quality.validate_silver(df.select(*reversed(df.columns)))
    with pytest.raises(ValueError, match="missing columns.*cep"):
        quality.validate_silver(df.drop("cep"))
    with pytest.raises(ValueError, match="unexpected columns.*extra"):
        quality.validate_silver(df.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="valor_venda is"):
        quality.validate_silver(df.withColumn("valor_venda", F.col("valor_venda").cast("double")))


GOLD_ROW = (date(2024, 3, 1), "1", "A", "RS", "Sul", "GNV", 5.0, 5.0, 4.0, 6.0, None, 2)


def gold(spark, *changes):
    names = GOLD.fieldNames()
    rows = [tuple((dict(zip(names, GOLD_ROW)) | change)[n] for n in names) for change in changes]
    return spark.createDataFrame(rows, GOLD)


@pytest.mark.parametrize(
    ("change", "found"),
    [
        ({}, {}),
        ({"preco_medio": 0.0}, {"metrics": 1}),
        ({"preco_mediano": -1.0}, {"metrics": 1}),
        ({"preco_minimo": 7.0}, {"metrics": 1}),
        ({"preco_maximo": 0.0}, {"metrics": 1}),
        ({"qtd_coletas": 0}, {"metrics": 1}),
        ({"preco_maximo": None}, {"required_preco_maximo": 1}),
        ({"codigo_ibge": None}, {"required_codigo_ibge": 1}),
    ],
)
def test_each_gold_rule(spark, change, found):
    df = gold(spark, change)
    assert counts(quality.gold_report(df)) == found
    if found:
        with pytest.raises(ValueError, match=next(iter(found))):
            quality.validate_gold(df)
    else:
        quality.validate_gold(df)


def test_gold_schema_includes_order(spark):
    df = gold(spark, {})
    with pytest.raises(ValueError, match="schema"):
        quality.validate_gold(df.select(*reversed(df.columns)))


def test_dimension(spark):
    good = ("1", "A", "RS", "Sul", "A")
    quality.validate_dimension(spark.createDataFrame([good], DIMENSION))
    bad = {
        "not_empty": [],
        "unique_codigo_ibge": [good, good],
        "required_regiao": [good, ("2", "B", "RS", None, "B")],
    }
    for check, rows in bad.items():
        with pytest.raises(ValueError, match=check):
            quality.validate_dimension(spark.createDataFrame(rows, DIMENSION))


def test_profile_of_one_partition(raw_frame, raw_row):
    blank = dict.fromkeys(RAW_HEADINGS)
    rows = [
        raw_row(),
        raw_row(),
        raw_row(Valor_de_Venda="5,99"),
        raw_row(Produto="ETANOL", Data_da_Coleta="01/02/2024"),
        raw_row(Produto="ETANOL", Data_da_Coleta=None),
        blank,
        blank,
        blank,
    ]
    df = raw_frame(rows, list(RAW_HEADINGS)).withColumns({"ano": F.lit(2024), "semestre": F.lit(1)})
    row = profiling.partition_profile(df).first()
    assert (row.total_linhas, row.total_colunas, row.linhas_vazias) == (8, 16, 3)
    assert (row.duplicatas_exatas, row.colisoes_chave_candidata) == (3, 1)
    assert (row.data_minima, row.data_maxima) == (date(2024, 2, 1), date(2024, 3, 7))
    assert row.produtos == [None, "ETANOL", "GASOLINA"]
    assert row.unidades_de_medida == [None, "R$ / litro"]
    assert row.colunas == list(RAW_HEADINGS)
    assert row.nulos["Complemento"] == 8 and row.nulos["Produto"] == 3
    assert row.nulos["Data da Coleta"] == 4
    assert profiling.key_collisions(df).first().quantidade == 3
    assert profiling.exact_duplicates(df).first().duplicatas_exatas == 3
    assert profiling.blank_rows(df).first().linhas_vazias == 3
    nulls = {r.coluna: r.nulos for r in profiling.null_counts(df).collect()}
    assert nulls == row.nulos
    values = [r.valor for r in profiling.distinct_sorted(df, "Produto").collect()]
    assert values == [None, "ETANOL", "GASOLINA"]
    assert profiling.max_decimal_places(df, "Valor de Venda").first()[0] == 0


def test_profile_counts_unreadable_dates(raw_frame, raw_row):
    rows = [raw_row(), raw_row(Data_da_Coleta="31/02/2024"), raw_row(Data_da_Coleta="31/02/2024")]
    df = raw_frame(rows, list(RAW_HEADINGS)).withColumns({"ano": F.lit(2024), "semestre": F.lit(1)})
    row = profiling.partition_profile(df).first()
    assert (row.total_linhas, row.datas_ilegiveis) == (3, 2)
    assert row.data_minima == row.data_maxima == date(2024, 3, 7)


def test_published_report_names_files(spark, tmp_path):
    from litro.plans.silver_to_gold import report_published_gold

    def row(month, code, price, product="GNV"):
        return (month, code, "A", "RS", "Sul", product, price, price, price, price, None, 1)

    def put(ano, rows):
        spark.createDataFrame(rows, GOLD).coalesce(1).write.mode("append").parquet(f"{tmp_path}/ano={ano}")

    put(2023, [row(date(2023, 1, 1), "1", 1.0), row(date(2023, 2, 1), None, 1.0), row(date(2023, 2, 1), None, 1.0)])
    put(2023, [row(date(2023, 1, 1), "1", -1.0)])
    put(2024, [row(date(2024, 1, 1), "1", 1.0), row(date(2023, 1, 1), "1", 2.0)])
    found = report_published_gold(spark, str(tmp_path)).where("violations > 0").collect()
    sizes = {(r.ano, r.linhas, r.check): r.violations for r in found}
    assert sizes == {
        (2023, 3, "required_codigo_ibge"): 2,
        (2023, 3, "grain"): 3,
        (2023, 1, "metrics"): 1,
        (2023, 1, "grain"): 1,
        (2024, 2, "grain"): 1,
        (2024, 2, "folder"): 1,
    }
    assert len({r.arquivo for r in found}) == 3
    assert report_published_gold(spark, str(tmp_path)).count() == 3 * 14
