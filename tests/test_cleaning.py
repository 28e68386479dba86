import datetime
import logging

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from litro.operators import cleaning
from litro.operators.quality import require_schema
from litro.schemas import SILVER


def test_values_are_normalised(raw_frame, raw_row):
    out = cleaning.to_silver(raw_frame([raw_row()]))
    require_schema(out, SILVER, "Silver")
    row = out.first()
    assert (row.cnpj_revenda, row.cep) == ("11222333000144", "90010000")
    assert row.data_coleta == datetime.date(2024, 3, 7)
    assert str(row.valor_venda) == "5.89"


def test_old_unit_spelling(raw_frame, raw_row):
    rows = [raw_row(Produto="GNV", Unidade_de_Medida="R$ / m3")]
    assert cleaning.to_silver(raw_frame(rows)).first().unidade_medida == "R$ / m³"


def test_missing_critical_column_is_an_error(raw_frame, raw_row):
    row = raw_row()
    del row["Valor de Venda"]
    with pytest.raises(ValueError, match="Colunas críticas ausentes.*Valor de Venda"):
        cleaning.to_silver(raw_frame([row]))


def test_missing_optional_column_becomes_null(raw_frame, raw_row):
    row = raw_row()
    del row["Bandeira"]
    out = cleaning.to_silver(raw_frame([row]))
    assert out.columns == SILVER.fieldNames() and out.first().bandeira is None


def test_unknown_column_is_reported_and_dropped(raw_frame, raw_row, caplog):
    with caplog.at_level(logging.WARNING):
        out = cleaning.to_silver(raw_frame([raw_row() | {"a.b `c`": "x"}]))
    assert out.columns == SILVER.fieldNames() and out.count() == 1
    assert "a.b `c`" in caplog.text


def test_exact_copies_go_but_other_prices_stay(raw_frame, raw_row):
    rows = [raw_row(), raw_row(), raw_row(Valor_de_Venda="5,99")]
    out = cleaning.to_silver(raw_frame(rows))
    assert sorted(str(r.valor_venda) for r in out.collect()) == ["5.89", "5.99"]


def test_rows_that_differ_only_in_a_dropped_column_stay(raw_frame, raw_row):
    rows = [raw_row() | {"Bairro": b} for b in ("CENTRO", "SUL", None, None)]
    out = cleaning.to_silver(raw_frame(rows))
    assert out.count() == 3 and out.distinct().count() == 1


def test_copies_in_other_partitions_stay(raw_frame, raw_row):
    df = raw_frame([raw_row()])
    both = df.withColumns({"ano": F.lit(2023), "semestre": F.lit(1)}).unionByName(
        df.withColumns({"ano": F.lit(2023), "semestre": F.lit(2)})
    )
    assert cleaning.to_silver(both.unionByName(both)).count() == 2


def test_only_wholly_blank_rows_are_dropped(raw_frame, raw_row):
    columns = list(raw_row())
    rows = [raw_row(), dict.fromkeys(columns), dict.fromkeys(columns) | {"Municipio": "X"}]
    df = raw_frame(rows, columns).withColumns({"ano": F.lit(2023), "semestre": F.lit(1)})
    assert cleaning.drop_blank_rows(df).count() == 2


def test_cleaning_is_idempotent_and_order_free(raw_frame, raw_row):
    rows = [raw_row(Revenda=f"POSTO {i % 5}", Valor_de_Venda=f"{i % 7},10") for i in range(60)]
    once = sorted(cleaning.to_silver(raw_frame(rows)).collect())
    back = sorted(cleaning.to_silver(raw_frame(rows[::-1])).collect())
    deduped = cleaning.drop_exact_duplicates(raw_frame(rows))
    assert once == back and len(once) == 35
    assert cleaning.drop_exact_duplicates(deduped).count() == deduped.count() == 35


def test_strict_and_tolerant_parsing(raw_frame, raw_row):
    df = raw_frame([raw_row(Valor_de_Venda="1,2,3"), raw_row(Data_da_Coleta="2024-03-07")])
    with pytest.raises(PySparkException, match="Invalid"):
        cleaning.to_silver(df).collect()
    tolerant = cleaning.to_silver(df, strict=False).collect()
    assert {(r.valor_venda is None, r.data_coleta is None) for r in tolerant} == {
        (True, False),
        (False, True),
    }
