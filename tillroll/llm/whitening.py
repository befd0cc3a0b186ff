"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi rotations.

Entries become integers (``floor(scale * c) + offset``), so sums and deviations
are exact. One pass sums the dimensions, a second the products of the centred
entries, one partial matrix a task; the partial rows are added in Spark, and the
driver gets one matrix, whose size is that of the dimensions. There the centred
scatter is factored with diagonal pivoting, and rotations make the columns of
the triangular factor itself orthogonal: their squared norms are the
eigenvalues, the columns at length 1 the components. No square of the factor
is formed, so small eigenvalues keep their relative accuracy. Two more passes
check the whitened covariance and return the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import written

SCALE, OFFSET = 1024, 100_000
#: Entries at or above this size are outside the exact integers and leave their row out.
LARGEST = float(1 << 42)


# -- the decomposition ------------------------------------------------------

def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, factor): ``a[order][:, order] = factor @ factor.T`` for a symmetric positive semidefinite ``a``.

    The factor is lower trapezoidal with as many columns as the rank to working precision."""
    a = np.array(a, np.float64)
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    left = np.diag(a).copy()
    bar = d * np.finfo(np.float64).eps * (left.max() if d else 0.0)
    for j in range(d):
        p = j + int(np.argmax(left[j:]))
        if left[p] <= bar:
            return order, factor[:, :j]
        if p != j:
            order[[j, p]], left[[j, p]] = order[[p, j]], left[[p, j]]
            factor[[j, p]] = factor[[p, j]]
        root = factor[j, j] = np.sqrt(left[j])
        column = a[order[j + 1:], order[j]] - factor[j + 1:, :j] @ factor[j, :j]
        factor[j + 1:, j] = column / root
        left[j + 1:] -= factor[j + 1:, j] ** 2
    return order, factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``n`` columns once, as rounds of disjoint pairs."""
    seats = list(range(n)) + ([-1] if n % 2 else [])
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(p, q) for p, q in zip(seats[:half], reversed(seats[half:]), strict=True) if p >= 0 and q >= 0]
        yield np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times an orthogonal matrix, with orthogonal columns."""
    u = np.array(factor, np.float64)
    bar = np.finfo(np.float64).eps * max(1, len(u)) / 4
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _rounds(u.shape[1]):
            a, b = u[:, p], u[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.abs(ab) / np.sqrt(aa * bb)
            turn = size > bar
            if not turn.any():
                continue
            worst = max(worst, float(size.max()))
            zeta = (bb - aa) / (2 * np.where(turn, ab, 1.0))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            u[:, p], u[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst == 0.0:
            break
    return u


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) by falling eigenvalue, as many as the rank; the largest entry of each is positive."""
    order, factor = pivoted_cholesky(covariance)
    rotated = jacobi_columns(factor)
    values = (rotated * rotated).sum(axis=0)
    vectors = np.zeros((rotated.shape[1], len(covariance)))
    vectors[:, order] = (rotated / np.sqrt(values)).T
    if len(vectors):
        largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
        vectors *= np.sign(largest)[:, None]
    by = np.argsort(-values, kind="stable")
    return values[by], vectors[by]


# -- passes over the table --------------------------------------------------

def fit_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): rows whose vector is not null or empty and has only finite entries within range."""
    v = F.col(vector).cast("array<double>")
    return (vectors.select(F.col(key).alias("id"), v.alias("v")).filter(F.size("v") > 0)
            .filter(F.forall("v", lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))))


def _integers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + OFFSET).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, n, s): rows and exact sum of dimension i among the vectors of length d, one row a task."""
    kept: dict[int, tuple[int, np.ndarray]] = {}
    for b in batches:
        column = b.column(0)
        lengths = np.diff(column.offsets.to_numpy())
        for d in np.unique(lengths).tolist():
            x = _integers(column.filter(pa.array(lengths == d)))
            n, s = kept.get(d, (0, np.zeros(d, object)))
            kept[d] = (n + len(x), s + x.sum(axis=0).astype(object))
    for d, (n, s) in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                          pa.array(s.tolist(), pa.int64())], ["d", "i", "n", "s"])


@dataclass
class Whitening:
    """Rows ``n``, exact ``sums`` by dimension, and the components kept: eigenvalues, vectors (one a row), shares of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    shares: np.ndarray

    def __post_init__(self):
        self.middle, self.rest = _centre(self.n, self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision: the integer part is taken off exactly."""
        return (x - self.middle).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sum over the dimensions of (n x - S)^2, as decimal(38, 0); null beyond that."""
        reach = int(max(abs(int(x.max())), abs(int(x.min())))) * self.n + max(abs(s) for s in self.sums) if len(x) else 0
        if reach < 1 << 62:
            y = x * np.int64(self.n) - np.array(self.sums, np.int64)
            if int(np.abs(y).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
        y = x.astype(object) * self.n - np.array(self.sums, object)
        exact = [int(t) for t in (y * y).sum(axis=1)]
        from decimal import Decimal
        return pa.array([Decimal(t) if t < 10 ** 38 else None for t in exact], pa.decimal128(38, 0))


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest integers of the means, and the rest of each mean."""
    middle = [round(Fraction(s, n)) for s in sums]
    return np.array(middle, np.int64), np.array([float(Fraction(s, n) - m) for s, m in zip(sums, middle, strict=True)])


def _products(centred: Callable[[np.ndarray], np.ndarray], d: int):
    """Maps batches to (part, i, row): row i of this task's sum of products of centred entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((d, d)), 0
        for b in batches:
            y = centred(_integers(b.column(0)))
            total += y.T @ y
            rows += len(y)
        if rows:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part] * d, pa.int32()), pa.array(range(d), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], ["part", "i", "row"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, row): the sum of the partial rows of each i, which are next to each other."""
    now, total = None, None
    for b in batches:
        for i, row in zip(b.column(1).to_pylist(), b.column(2), strict=True):
            row = row.values.to_numpy()
            if i != now:
                if now is not None:
                    yield _one_row(now, total)
                now, total = i, np.zeros(len(row))
            total += row
    if now is not None:
        yield _one_row(now, total)


def _one_row(i: int, row: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row], pa.list_(pa.float64()))], ["i", "row"])


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8) -> Whitening | None:
    """The first ``k`` components of all rows of ``vectors`` that take part; None where none does."""
    rows = fit_rows(vectors, key, vector).select("v")
    sums = written(rows.mapInArrow(_sums, "d int, i int, n long, s long").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")),
                   "whitening-sums")
    most = sums.filter("i = 0").orderBy(F.desc("n"), "d").first()
    if most is None:
        return None
    d, n = most["d"], most["n"]
    totals = [x["s"] for x in sums.filter(F.col("d") == d).orderBy("i").select("s").collect()]
    bare = Whitening(n, totals, np.zeros(0), np.zeros((0, d)), np.zeros(0))
    partial = rows.filter(F.size("v") == d).mapInArrow(_products(bare.centred, d), "part int, i int, row array<double>")
    added = partial.repartition("i").sortWithinPartitions("i", "part").mapInArrow(_added, "i int, row array<double>")
    scatter = np.zeros((d, d))
    for i, row in added.collect():  # d rows of d numbers
        scatter[i] = row
    covariance = (scatter + scatter.T) / (2 * n)
    values, found = components(covariance)
    trace = float(np.trace(covariance))
    return Whitening(n, totals, values[:k], found[:k], values[:k] / trace if trace else values[:k])


def _moments(model: Whitening):
    """Maps batches to (i, j, n, mi, mj, m): rows, means and centred product sum of each pair of whitened components in this task."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, product = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if not b.num_rows:
                continue
            w = model.whitened(_integers(b.column(0)))
            own = w.mean(axis=0)
            step, size = own - mean, len(w)
            product += (w - own).T @ (w - own) + np.outer(step, step) * (n * size / (n + size))
            mean = mean + step * (size / (n + size))
            n += size
        if n:
            i, j = (x.ravel() for x in np.indices((k, k)))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(k * k, n, np.int64)),
                                              pa.array(mean[i]), pa.array(mean[j]), pa.array(product.ravel())], ["i", "j", "n", "mi", "mj", "m"])
    return run


def identity_error(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance (centred, divisor n) minus the identity."""
    rows = fit_rows(vectors, key, vector).select("v").filter(F.size("v") == len(model.sums))
    parts = written(rows.mapInArrow(_moments(model), "i int, j int, n long, mi double, mj double, m double"), "whitening-moments")
    means = parts.filter("i = j").groupBy("i").agg((F.sum(F.col("n") * F.col("mi")) / F.sum("n")).alias("mean"))
    at = {x["i"]: x["mean"] for x in means.collect()}
    centre = F.array(*(F.lit(at[i]) for i in range(len(model.values))))
    spread = (F.col("m") + F.col("n") * (F.col("mi") - centre[F.col("i")]) * (F.col("mj") - centre[F.col("j")]))
    found = parts.groupBy("i", "j").agg((F.sum(spread) / F.sum("n")).alias("c"))
    return max(abs(x["c"] - (x["i"] == x["j"])) for x in found.collect())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per vector that takes part and component.

    Rows take no part where the vector is null or empty, holds a null, a
    non-finite entry or one of 2^42 or more, or has another length than most
    (the shorter of equally frequent ones). There are as many components as the
    rank of the covariance, ``k`` at most: none (no rows) for an empty table or
    equal vectors. Keys may be null or repeat; other columns are not read.
    ``deviation`` is decimal(38, 0). The four passes read the table itself."""
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(vectors, key, vector, k)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model, key, vector)
    count = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _integers(b.column(1))
            rows, at = b.num_rows, np.repeat(np.arange(b.num_rows), count)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * count, model.n, np.int64)), model.deviations(x).take(pa.array(at)),
                 pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.shares, rows)), pa.array(np.full(rows * count, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit_rows(vectors, key, vector).filter(F.size("v") == len(model.sums)).mapInArrow(run, schema)
