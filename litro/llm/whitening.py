"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, the method alternates X v and X'u and orthogonalises each new vector against
all earlier ones: X V = U B, where B is upper bidiagonal and small. The singular values and right
singular vectors of B, taken through V, give the components and their deviations. The columns of U are
as long as the table and are never stored: u = X w for a vector w as short as an embedding, which the
driver keeps, so that one scan computes u = X w and X'u block by block, and the products of u with all
earlier columns follow from X'u. Only vectors as long as an embedding reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import table

#: An entry c becomes floor(SCALE * c) + SHIFT; entries whose floor is not below LARGEST count as not finite.
SCALE, SHIFT, LARGEST = 1024, 100_000, 1 << 45
COMPONENTS = 8
#: Entries of a block of rows that is multiplied at once.
BLOCK = 1 << 19
#: Sums of so many tasks are added up on the driver; those of more tasks are first added in tasks.
DIRECT = 256
#: A residual below this share of the largest singular value is converged; what is left of a vector below it is nothing.
TOLERANCE = 1e-14


@dataclass(frozen=True)
class Model:
    """n rows, sums of their entries, components as columns, their eigenvalues, and the covariance's trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float
    steps: int
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _usable(vector: Column) -> Column:
    """Neither null nor holding a null or an entry that is not finite."""
    fine = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST / SCALE), F.lit(False)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def vectors(frame: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector array<double>): the usable vectors of the most frequent length, of two such the longer."""
    rows = frame.select(frame[id_column].cast("long").alias("vec_id"), frame[vector].cast("array<double>").alias("vector"))
    rows = rows.where(_usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    first = lengths.first()
    return rows.where(F.size("vector") == (first.size if first else 0))


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    """floor(SCALE * c) of a batch's vectors, a row each."""
    column = batch["vector"]
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks of integers of the fewest bytes that hold them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _integers(batch)
        step = max(1, BLOCK // x.shape[1])
        for i in range(0, len(x), step):
            part = x[i : i + step]
            kind = next(k for k in ("<i2", "<i4", "<i8") if np.abs(part).max() <= np.iinfo(k).max)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind]), pa.array([part.shape[1]], pa.int32()), pa.array([part.astype(kind).tobytes()])], ["kind", "width", "x"]
            )


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, width, x in zip(batch["kind"].to_pylist(), batch["width"].to_pylist(), batch["x"], strict=True):
            yield np.frombuffer(x.as_buffer(), kind).reshape(-1, width)


def _exact(x: np.ndarray) -> np.ndarray:
    """Integers in which sums of squares of a block do not overflow."""
    return x.astype(np.int64) if np.abs(x, dtype=np.int64).max() < 1 << 20 else x.astype(object)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, squares = 0, None, None
    for block in _each(batches):
        x = _exact(block)
        s, q = x.sum(0).astype(object), (x * x).sum(0).astype(object)
        n, sums, squares = n + len(x), s if sums is None else sums + s, q if squares is None else squares + q
    if n:
        exact = pa.decimal128(38, 0)
        columns = [pa.array([Decimal(int(v)) for v in values], exact) for values in (sums, squares)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), *columns], ["at", "n", "s", "q"])


MOMENTS = "at int, n long, s decimal(38,0), q decimal(38,0)"


def _totals(value: Callable[[np.ndarray], np.ndarray]):
    """For mapInArrow: one row with the sum of `value` over a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _each(batches):
            v = value(block)
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for v in batch["v"]:
            total = v.values.to_numpy() + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])


def _total(blocks: DataFrame, tasks: int, value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `value` over all blocks, in one scan."""
    parts = blocks.mapInArrow(_totals(value), "v array<double>")
    if tasks > DIRECT:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(_added, "v array<double>")
    return np.array([math.fsum(c) for c in zip(*[r.v for r in parts.collect()], strict=True)])


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], width: int, energy: float, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Right singular vectors as columns, singular values, and the steps taken, for the `most` largest.

    product(w) is X'(X w), computed over the rows; energy is the sum of X's squared entries. A vector that
    vanishes in orthogonalisation is replaced by a fresh one, so equal singular values and missing rank are found.
    """
    draw = np.random.default_rng(11)
    least = TOLERANCE * math.sqrt(energy)
    v_all, w_all, t_all = (np.zeros((width, 0)) for _ in range(3))
    diagonal, above, fresh = [], [], False

    def against(p: np.ndarray) -> np.ndarray:
        for _ in range(2):
            p = p - v_all @ (v_all.T @ p)
        return p

    def start() -> np.ndarray:
        p = against(draw.standard_normal(width))
        return p / np.linalg.norm(p)

    v, beta = start(), 0.0
    while True:
        # X v, less the earlier columns of U: once more where most of it cancels.
        w = v - beta * w_all[:, -1] if len(diagonal) else v
        t = product(w)
        norm = max(0.0, w @ t)
        for _ in range(2):
            g = w_all.T @ t
            w, t = w - w_all @ g, t - t_all @ g
            left = max(0.0, w @ t)
            if left > 0.5 * norm or left <= least**2:
                break
            t, norm = product(w), left
        alpha = math.sqrt(left)
        if alpha <= least:
            alpha, w, t = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, t = w / alpha, t / alpha
        v_all, w_all, t_all = (np.column_stack(x) for x in ((v_all, v), (w_all, w), (t_all, t)))
        diagonal.append(alpha)
        # X'u, less the earlier columns of V.
        p = against(t - alpha * v)
        beta = float(np.linalg.norm(p))
        k = len(diagonal)
        b = np.diag(diagonal) + np.diag(above, 1)
        left_vectors, singular, right = np.linalg.svd(b)
        rest = energy - float((b**2).sum())
        if k == width or rest <= 1e-13 * energy:
            break
        fresh = fresh or beta <= least
        if not fresh and k >= most and (beta * np.abs(left_vectors[-1, :most])).max() <= TOLERANCE * singular[0]:
            break
        if beta <= least:
            beta, v = 0.0, start()
        else:
            v = p / beta
        above.append(beta)
    chosen = [i for i in range(min(most, k)) if singular[i] > width * TOLERANCE * singular[0]] if singular[0] > least else []
    return v_all @ right.T[:, chosen], singular[chosen], k


def fit(rows: DataFrame, most: int = COMPONENTS) -> Model | None:
    """Components of the rows of `vectors`, by scans over them; None without rows."""
    blocks = rows.select("vector").mapInArrow(_blocks, "kind string, width int, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = blocks.mapInArrow(_moments, MOMENTS).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        moments = sorted(found.collect())  # a row for each dimension
        if not moments:
            return None
        n, sums = moments[0].n, [int(r.s) for r in moments]
        scatter = sum(n * int(r.q) - int(r.s) ** 2 for r in moments)  # n times the energy, exact
        mean, tasks = np.array([s / n for s in sums]), blocks.rdd.getNumPartitions()

        def product(w: np.ndarray) -> np.ndarray:
            def value(block: np.ndarray) -> np.ndarray:
                y = block - mean
                return (y @ w) @ y

            return _total(blocks, tasks, value)

        none = np.zeros((len(sums), 0)), np.zeros(0), 0
        components, singular, steps = bidiagonalise(product, len(sums), scatter / n, most) if scatter else none
        values = singular**2 / n
        error = 0.0
        if len(values):
            scaled = components / np.sqrt(values)
            middle = _total(blocks, tasks, lambda block: ((block - mean) @ scaled).sum(0)) / n

            def square(block: np.ndarray) -> np.ndarray:
                white = (block - mean) @ scaled - middle
                return (white.T @ white).ravel()

            error = float(np.abs(_total(blocks, tasks, square).reshape(len(values), -1) / n - np.eye(len(values))).max())
        shifted = tuple(s + n * SHIFT for s in sums)
        return Model(n, shifted, components, values, scatter / n / n, steps, error)
    finally:
        blocks.unpersist()


WHITE = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal]:
    """Sum over dimensions of (n * x - sum)**2, exact."""
    largest = n * int(np.abs(x).max()) + max(map(abs, sums.tolist()))
    if largest < 1 << 62:
        d = n * x - sums.astype(np.int64)
        top = int(np.abs(d).max())
        return [Decimal(int(v)) for v in ((d * d).sum(1) if top * top * x.shape[1] < 1 << 62 else (d.astype(object) ** 2).sum(1))]
    return [Decimal(int(v)) for v in ((n * x.astype(object) - sums) ** 2).sum(1)]


def _whiten(model: Model):
    plain = np.array([s - model.n * SHIFT for s in model.sums], object)
    mean = np.array([s / model.n for s in plain])
    m = len(model.values)
    scaled, explained = model.components / np.sqrt(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch)
            at = pa.array(np.repeat(np.arange(len(x)), m))
            numbers = np.tile(np.arange(m), len(x))
            columns = [
                batch["vec_id"].take(at),
                pa.array(numbers + 1, pa.int32()),
                pa.array(np.full(len(at), model.n, np.int64)),
                pa.array(_deviations(x, model.n, plain), pa.decimal128(38, 0)).take(at),
                pa.array(((x - mean) @ scaled).ravel()),
                pa.array(explained[numbers]),
                pa.array(np.full(len(at), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WHITE.split(", ")])

    return run


def whiten(frame: DataFrame, most: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): up to `most` rows for each usable vector.

    Components are numbered by falling eigenvalue; those without deviation (constant data, missing rank, a
    single row) are left out, so an empty table and one of equal rows give no rows. Nulls: a missing vector
    and one with a null, an infinity, NaN or an entry of 2**35 or more is left out, as are an empty vector and one of
    another length than most vectors have; a missing id stays null. Repeated rows count each. Equal
    eigenvalues come in the order of the method, which depends on no chance. Other columns are ignored.
    """
    rows = vectors(frame, id_column, vector)
    model = fit(rows, most)
    if model is None or not len(model.values):
        return frame.sparkSession.createDataFrame([], WHITE)
    return rows.mapInArrow(_whiten(model), WHITE)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as long; null where it does not fit one, which takes some hundred million rows."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
