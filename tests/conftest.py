import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from litro.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cpus=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_row():
    """One raw record under the source's headings, with changes by heading."""
    base = {
        "Regiao - Sigla": "S",
        "Estado - Sigla": "RS",
        "Municipio": "PORTO ALEGRE",
        "Revenda": "POSTO UM",
        "CNPJ da Revenda": "11.222.333/0001-44",
        "Cep": "90.010-000",
        "Produto": "GASOLINA",
        "Data da Coleta": "07/03/2024",
        "Valor de Venda": "5,89",
        "Unidade de Medida": "R$ / litro",
        "Bandeira": "BRANCA",
    }

    def make(**changes):
        return base | {k.replace("_", " "): v for k, v in changes.items()}

    return make


@pytest.fixture
def raw_frame(spark):
    def make(rows, columns=None):
        columns = columns or list(rows[0])
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)

    return make
