import pytest
from pyspark.sql import types as T

from litro.operators import contract
from litro.schemas import GOLD, SILVER

WANT = T.StructType([T.StructField(c, T.StringType()) for c in "abcd"])


def schema(text):
    return T._parse_datatype_string(text)


def told(found, expected=WANT):
    return [(d.column, d.problem) for d in contract.differences(schema(found), expected)]


def test_an_equal_schema_has_no_difference():
    assert told("a string NOT NULL, b string, c string, d string") == []
    assert contract.differences(SILVER, SILVER) == contract.differences(GOLD, GOLD) == []


@pytest.mark.parametrize(
    ("found", "wanted"),
    [
        ("a string, c string, d string", [("b", "ausente")]),
        ("a string, b string, x int, c string, d string", [("x", "inesperada")]),
        ("a string, b int, c string, d string", [("b", "tipo")]),
        ("d string, a string, b string, c string", [("d", "posição")]),
        ("b string, a string, d string, c string", [("a", "posição"), ("c", "posição")]),
        ("d int, y string, a string, c string, x string", [("b", "ausente"), ("d", "tipo"), ("d", "posição"), ("y", "inesperada"), ("x", "inesperada")]),
        ("x string", [(c, "ausente") for c in "abcd"] + [("x", "inesperada")]),
    ],
)
def test_differences_in_order(found, wanted):
    assert told(found) == wanted


def test_few_columns_move():
    names = list("abcdefghij")
    want = T.StructType([T.StructField(c, T.StringType()) for c in names])
    moved = names[3:] + names[:3]
    assert told(", ".join(f"{c} string" for c in moved), want) == [(c, "posição") for c in "abc"]


def test_report_counts_values(spark):
    df = spark.createDataFrame([("1", "x", 1), (None, "2", 2), ("a", None, 3)], "b string, z string, a int")
    expected = schema("a int, b int, c date")
    rows = [tuple(r) for r in contract.contract_report(df, expected).orderBy("ordem").collect()]
    assert rows == [
        (1, "a", "posição", "int", "int", 1, 3, 3, None),
        (2, "b", "tipo", "int", "string", 2, 1, 2, 1),
        (3, "c", "ausente", "date", None, 3, None, None, None),
        (4, "z", "inesperada", None, "string", None, 2, 2, None),
    ]
    clean = contract.contract_report(df, df.schema)
    assert clean.count() == 0 and clean.columns[-2:] == ["valores", "incompativeis"]
    dropped = contract.contract_report(df.select("a"), schema("a int, b int")).collect()
    assert [(r.coluna, r.valores) for r in dropped] == [("b", None)]


def test_require_contract_names_all(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    with pytest.raises(ValueError, match="Silver: a: posição.*; c: ausente"):
        contract.require_contract(df, schema("a int, b int, c int"), "Silver")
    contract.require_contract(df, schema("a int, b int"), "Silver", ordered=False)
