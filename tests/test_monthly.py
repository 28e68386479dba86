import random
import statistics
from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from litro.operators import monthly, quality
from litro.operators.municipalities import ambiguous_match_keys, enrich, match_coverage
from litro.schemas import DIMENSION, GOLD

ENRICHED = (
    "data_coleta date, codigo_ibge string, municipio string, uf string, regiao string, "
    "produto string, valor_venda decimal(10,2)"
)
PLACE = ("4314902", "Porto Alegre", "RS", "Sul")


def frame(spark, rows):
    return spark.createDataFrame(rows, ENRICHED)


def two_rows(spark):
    return frame(
        spark,
        [
            (date(2024, 3, 7), *PLACE, "GASOLINA", Decimal("5.10")),
            (date(2024, 3, 28), *PLACE, "GASOLINA", Decimal("5.50")),
        ],
    )


def test_metrics_of_two_prices(spark):
    row = monthly.monthly_prices(two_rows(spark)).first()
    assert row.ano_mes == date(2024, 3, 1)
    assert row.preco_medio == pytest.approx(5.30) and row.preco_mediano == pytest.approx(5.30)
    assert (row.preco_minimo, row.preco_maximo, row.qtd_coletas) == (5.10, 5.50, 2)
    assert row.desvio_padrao == pytest.approx(0.4 / 2**0.5)


def test_products_stay_apart_and_the_contract_holds(spark):
    other = frame(spark, [(date(2024, 3, 9), *PLACE, "ETANOL", Decimal("3.90"))])
    gold = monthly.monthly_prices(two_rows(spark).unionByName(other))
    assert {r.produto: r.qtd_coletas for r in gold.collect()} == {"GASOLINA": 2, "ETANOL": 1}
    assert gold.where("produto = 'ETANOL'").first().desvio_padrao is None
    quality.validate_gold(gold)


def test_doubled_gold_violates_the_grain(spark):
    gold = monthly.monthly_prices(two_rows(spark))
    with pytest.raises(ValueError, match="combinações duplicadas"):
        quality.validate_grain(gold.unionByName(gold))


def random_prices(seed=3):
    """Many small groups, and one group with a third of all rows; some prices are null."""
    draw = random.Random(seed)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        month = 1 if hot else draw.randint(1, 4)
        place = PLACE if hot else (str(draw.randint(1, 5)), "Outra", "SP", "Sudeste")
        price = None if draw.random() < 0.02 else Decimal(draw.randint(300, 900)) / 100
        product = "GASOLINA" if hot else draw.choice(["GASOLINA", "ETANOL", None])
        rows.append((date(2024, month, draw.randint(1, 28)), *place, product, price))
    return rows + [(date(2025, 1, 1), *PLACE, "GNV", None)]


def test_statistics_equal_brute_force(spark):
    rows = random_prices()
    groups = defaultdict(list)
    for day, *key, price in rows:
        groups[(day.replace(day=1), *key)].append(price)
    gold = monthly.monthly_prices(frame(spark, rows)).collect()
    assert len(gold) == len(groups) and sum(r.qtd_coletas for r in gold) == len(rows)
    for r in gold:
        all_prices = groups[tuple(r)[:6]]
        prices = [p for p in all_prices if p is not None]
        assert r.qtd_coletas == len(all_prices)
        if not prices:
            assert r.preco_medio is r.preco_mediano is r.preco_minimo is r.desvio_padrao is None
            continue
        assert r.preco_medio == float(sum(prices)) / len(prices)
        assert r.preco_mediano == pytest.approx(float(statistics.median(prices)), abs=1e-12)
        assert (r.preco_minimo, r.preco_maximo) == (float(min(prices)), float(max(prices)))
        assert r.preco_minimo <= r.preco_mediano <= r.preco_maximo
        if len(prices) > 1:
            assert r.desvio_padrao == pytest.approx(float(statistics.stdev(prices)), abs=1e-9)
        else:
            assert r.desvio_padrao is None


def dimension(spark, rows):
    return spark.createDataFrame(rows, DIMENSION)


MUNICIPALITIES = [
    ("1", "São José", "SC", "Sul", "SAO JOSE"),
    ("2", "Mogi-Mirim", "SP", "Sudeste", "MOGIMIRIM"),
    ("3", "Repetida", "SP", "Sudeste", "REPETIDA"),
    ("4", "Repetida", "SP", "Sudeste", "REPETIDA"),
]


def silver(spark):
    names = [("SC", "SAO JOSE"), ("SC", "São José"), ("SP", "MOGI MIRIM"), ("SP", "Mogi-Mirim")]
    names += [("SP", "REPETIDA"), ("RJ", "SAO JOSE"), (None, "SAO JOSE"), ("SP", None)]
    rows = [
        ("X", uf, name, "POSTO", "1" * 14, None, "GASOLINA", date(2024, 1, d), Decimal(d), "u", "b")
        for uf, name in names
        for d in (1, 2, 3)
    ]
    schema = (
        "regiao string, uf string, municipio string, revenda string, cnpj_revenda string, "
        "cep string, produto string, data_coleta date, valor_venda decimal(10,2), "
        "unidade_medida string, bandeira string"
    )
    return spark.createDataFrame(rows, schema)


def test_match_replaces_name_and_region(spark):
    out = enrich(silver(spark), dimension(spark, MUNICIPALITIES))
    assert out.columns == (
        "uf revenda cnpj_revenda cep produto data_coleta valor_venda unidade_medida bandeira "
        "codigo_ibge municipio regiao"
    ).split()
    found = {
        (r.uf, r.codigo_ibge, r.municipio, r.regiao): r.n
        for r in out.groupBy("uf", "codigo_ibge", "municipio", "regiao")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    assert found == {
        ("SC", "1", "São José", "Sul"): 6,
        ("SP", "2", "Mogi-Mirim", "Sudeste"): 3,
        ("SP", "3", "Repetida", "Sudeste"): 3,
        ("SP", "4", "Repetida", "Sudeste"): 3,
        ("SP", None, None, None): 6,
        ("RJ", None, None, None): 3,
        (None, None, None, None): 3,
    }


def test_large_dimension_still_matches_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    wide = sorted(map(str, enrich(silver(spark), dimension(spark, MUNICIPALITIES)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich(silver(spark), dimension(spark, MUNICIPALITIES))
        assert sorted(map(str, joined.collect())) == wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counting_before_matching_gives_the_same_gold(spark):
    places = dimension(spark, MUNICIPALITIES)
    direct = monthly.monthly_prices(enrich(silver(spark), places))
    early = monthly.monthly_prices_of_places(silver(spark), places)
    assert sorted(map(str, early.collect())) == sorted(map(str, direct.collect()))
    assert early.columns == GOLD.fieldNames()
    unmatched = early.where("codigo_ibge IS NULL AND uf = 'RJ'")
    with pytest.raises(ValueError, match="required_codigo_ibge"):
        quality.validate_gold(unmatched)


def test_match_reports(spark):
    prices = silver(spark).withColumns({"ano": F.lit(2024), "semestre": F.lit(1)})
    places = dimension(spark, MUNICIPALITIES)
    coverage = match_coverage(prices, places.where("codigo_ibge <> '4'")).first()
    assert (coverage.linhas, coverage.sem_codigo) == (24, 12)
    assert [tuple(r) for r in ambiguous_match_keys(places).collect()] == [("SP", "REPETIDA", 2)]


def test_sort_and_preview(spark):
    gold = monthly.monthly_prices(frame(spark, random_prices()))
    keys = [(r.ano_mes, r.codigo_ibge, r.produto or "") for r in monthly.sorted_prices(gold).collect()]
    assert keys == sorted(keys)
    assert [(r.ano_mes, r.codigo_ibge, r.produto or "") for r in monthly.preview(gold, 4).collect()] == keys[:4]
