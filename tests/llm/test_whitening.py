import numpy as np
import pytest
from pyspark.sql import functions as F

from litro.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)


def expected(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + whitening.SHIFT
    n, s = len(x), x.sum(0)
    y = x - s / n
    values, columns = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x - s) ** 2).sum(1), values[::-1], y @ columns[:, ::-1]


def drawn(n, width, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, width)) * np.linspace(3, 0.2, width) + rng.standard_normal(width)).tolist()


@pytest.mark.parametrize("width", [1, 5, 24])
def test_equals_a_dense_decomposition(spark, width):
    vectors = drawn(300, width)
    got = whitening.whiten(frame(spark, enumerate(vectors))).toPandas().sort_values(["vec_id", "component"])
    n, deviations, values, projected = expected(vectors)
    m = min(8, width)
    assert len(got) == 300 * m and set(got.n) == {n}
    assert [int(v) for v in got.deviation[::m]] == deviations.tolist()
    assert np.allclose(got.explained[:m], values[:m] / values.sum(), rtol=1e-12)
    white = got.whitened.to_numpy().reshape(-1, m)
    assert np.allclose(np.abs(white), np.abs(projected[:, :m] / np.sqrt(values[:m])), atol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-12


def test_sums_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DIRECT", 1)
    vectors = drawn(100, 4)
    model = whitening.fit(whitening.vectors(frame(spark, enumerate(vectors))))
    assert np.allclose(model.values, expected(vectors)[2], rtol=1e-12)


@pytest.mark.parametrize("values", [[4.0] * 6, [9.0, 9.0, 9.0, 1.0, 0.0, 0.0], [5.0, 0.0, 0.0, 0.0, 0.0, 0.0], [1e8, 1e4, 1.0, 1e-3, 1e-3, 1e-3]])
def test_equal_and_vanishing_values(values):
    """Ties and missing rank, against the matrix itself."""
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((6, 6)))[0]
    x = np.sqrt(values)[:, None] * basis.T
    gram = x.T @ x
    columns, singular, _ = whitening.bidiagonalise(lambda w: x.T @ (x @ w), 6, float(sum(values)), 4)
    wanted = [v for v in sorted(values, reverse=True)[:4] if v > 0]
    kept = len(singular)
    assert kept == len(wanted) or values[0] == 1e8
    assert np.allclose(singular[:kept] ** 2, wanted[:kept], rtol=1e-7)
    assert np.allclose(columns.T @ columns, np.eye(kept), atol=1e-12)
    assert np.allclose(gram @ columns, columns * singular**2, atol=1e-10 * values[0])


def test_the_factorisation_holds():
    """X V = U B with orthonormal U and V, by the vectors the products were asked for."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((50, 10)) * np.linspace(5, 0.5, 10)
    asked = []

    def product(w):
        asked.append(w)
        return x.T @ (x @ w)

    columns, singular, steps = whitening.bidiagonalise(product, 10, float((x**2).sum()), 10)
    assert steps == 10 and len(asked) <= 30
    assert np.allclose(singular, np.linalg.svd(x, compute_uv=False), rtol=1e-12)
    assert np.allclose(np.abs(columns), np.abs(np.linalg.svd(x)[2].T), atol=1e-9)


def test_few_steps_where_the_spectrum_falls():
    values = 2.0 ** -np.arange(60)
    _, singular, steps = whitening.bidiagonalise(lambda w: values * w, 60, float(values.sum()), 3)
    assert steps < 40 and np.allclose(singular**2, values[:3], rtol=1e-12)


def test_nulls_lengths_and_repeats(spark):
    good = drawn(20, 3)
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0]), (106, [1e30, 1.0, 1.0])]
    rows = [*enumerate(good), (None, good[0]), (3, good[3]), *bad]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    n, _, values, _ = expected([*good, good[0], good[3]])
    assert set(got.n) == {n} and len(got) == 22 * 3
    assert len(got[got.vec_id.isna()]) == 3 and len(got[got.vec_id == 3]) == 6
    assert not set(got.vec_id.dropna()) & {100, 101, 102, 103, 104, 105, 106}
    assert np.allclose(sorted(set(got.explained), reverse=True), values / values.sum(), rtol=1e-12)


def test_nothing_to_whiten(spark):
    empty = whitening.whiten(frame(spark, [(1, None)]))
    assert empty.count() == 0 and empty.columns == [c.split()[0] for c in whitening.WHITE.split(", ")]
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0


def test_deviations_beyond_a_long():
    x = np.array([[1 << 40, -(1 << 40)], [0, 3]])
    sums = x.astype(object).sum(0)
    got = whitening._deviations(x, 1 << 25, sums)
    assert [int(v) for v in got] == [sum(((1 << 25) * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]


def test_query_returns_longs(spark):
    got = whitening.query(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["deviation"] == "bigint"
    assert got.where(F.col("deviation").isNull()).count() == 0
