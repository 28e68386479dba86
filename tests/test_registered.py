"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_points
from litro.workload.queries import QUERIES as OWN

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_sql():
    """All but text operators that SQL cannot express; their own tests have brute force."""
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", SQL)
def test_query_equals_sql(spark, database, key):
    assert difference(spark, database, QUERIES[key], SQL[key], SF_DIR) is None


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["regiao", "produto", "preco_medio_ponderado", "total_coletas"]
    assert result.count() > 0
