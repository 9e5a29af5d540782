"""Whitening of vectors.

Tasks add up the entries, then, centred, their products; what the driver gets is as large as
the square of the dimension, however many vectors there are. There the covariance matrix is
brought to tridiagonal form by reflections, its leading eigenvalues are found by bisection on
the number of sign changes, and their vectors by inverse iteration, made orthogonal within
clusters of close eigenvalues. The components are broadcast and each task projects its rows.

Entries are whole numbers, and products are taken of whole distances from the rounded mean,
so that sums do not depend on how rows are spread as long as they stay below 2 ** 53.

Defined results: vectors that are null, empty, or hold a null, a non-finite entry or one of
2 ** 40 or more take no part, nor do those of another length than most (of lengths equally
frequent, the longer one). Repeated rows and repeated or null ids each count and get their
rows. Components whose eigenvalue is zero up to rounding can't be scaled and are left out, so
one vector alone, or a table without vectors, gives no row. ``deviation`` is null where it
does not fit a long. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import small, written

#: Entries become floor(SCALE * entry) + SHIFT; larger ones than LARGEST are not whole numbers.
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**40
COMPONENTS = 32
#: Rows that a task holds as a matrix at a time.
ROWS = 4096
#: Eigenvalues nearer than this share of the largest are one cluster; rounds of inverse iteration.
CLUSTER, ROUNDS = 1e-3, 5


def whole_vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the rows of ``batch`` that take part and their whole entries, as a matrix."""
    vectors = batch.column("v")
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    bad = ~(np.abs(values) < LARGEST)  # also where an entry is null or not a number
    spoilt = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[bad], minlength=len(lengths))
    for length in np.unique(lengths[(lengths > 0) & (spoilt == 0)]):
        rows = np.flatnonzero((lengths == length) & (spoilt == 0))
        entries = values[starts[rows, None] + np.arange(length)]
        yield rows, np.floor(SCALE * entries).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Fit:
    """What is known of the fit list: its sums, the leading eigenvalues and their vectors (columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean, which is taken off in two steps to keep its digits."""
        near = [round(Decimal(s) / self.n) for s in self.sums]
        rest = [float(Decimal(s - m * self.n) / self.n) for s, m in zip(self.sums, near, strict=True)]
        return (x - np.array(near, np.int64)).astype(float) - np.array(rest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of squares of n * x - S for each row."""
        apart = np.abs(self.centred(x)).max(initial=0) * self.n + 1
        kind = np.int64 if apart**2 * x.shape[1] < 2**62 and np.abs(x).max(initial=0) * self.n < 2**62 else object
        own = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        squares = (own * own).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in squares]


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors that take part and the sum of each entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_length: dict[int, tuple[int, list[int]]] = {}
        for batch in small(batches, ROWS):
            for picked, x in whole_vectors(batch):
                n, sums = of_length.get(x.shape[1], (0, [0] * x.shape[1]))
                of_length[x.shape[1]] = n + len(picked), [a + b for a, b in zip(sums, x.sum(axis=0).tolist(), strict=True)]
        lengths = list(of_length)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lengths, pa.int32()),
                pa.array([of_length[k][0] for k in lengths], pa.int64()),
                pa.array([[Decimal(s) for s in of_length[k][1]] for k in lengths], pa.list_(pa.decimal128(38, 0))),
            ],
            names=["length", "n", "sums"],
        )

    partial = written(rows.select("v").mapInArrow(add, "length int, n long, sums array<decimal(38,0)>"), "sums")
    chosen = partial.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if chosen is None:
        return 0, []
    entries = partial.where(F.col("length") == chosen["length"]).select(F.posexplode("sums").alias("i", "s"))
    sums = {r["i"]: int(r["s"]) for r in entries.groupBy("i").agg(F.sum("s").alias("s")).collect()}  # one for each dimension
    return chosen["n"], [sums[i] for i in range(chosen["length"])]


def _covariance(rows: DataFrame, width: int, length: int, n: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Covariance, divisor ``n``, of ``of(x)``, which is centred but for a remainder that is taken off here."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in small(batches, ROWS):
            for _, x in whole_vectors(batch):
                if x.shape[1] == length:
                    y = of(x)
                    total[:width] += y.T @ y
                    total[width] += y.sum(axis=0)
        entries = pa.ListArray.from_arrays(pa.array(np.arange(width + 2, dtype=np.int32) * width), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)), entries], names=["i", "row"])

    partial = rows.select("v").mapInArrow(products, "i int, row array<double>")
    summed = partial.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    line = F.array_sort(F.collect_list(F.struct("j", "x")))["x"].alias("row")  # as many entries as dimensions
    total = np.zeros((width + 1, width))
    for batch in summed.groupBy("i").agg(line).toArrow().to_batches():
        for i, row in zip(batch.column("i").to_pylist(), batch.column("row"), strict=True):
            total[i] = row.values.to_numpy()
    rest = total[width] / n
    return total[:width] / n - np.outer(rest, rest)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that bring a symmetric matrix to that form."""
    a = matrix.astype(float).copy()
    mirrors = []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size > 0:
            end = -np.copysign(size, v[0])
            v[0] -= end
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k] = end
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def largest_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, by bisection."""
    n = len(diagonal)
    beside = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low = np.full(k, (diagonal - beside).min())
    high = np.full(k, (diagonal + beside).max())
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0)))
    wanted = n - np.arange(k)  # so many eigenvalues lie below anything above the k-th one
    while True:
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        q = diagonal[0] - middle
        below = (q < 0).astype(int)
        for i in range(1, n):
            q = diagonal[i] - middle - off[i - 1] ** 2 / np.where(np.abs(q) < tiny, -tiny, q)
            below += q < 0
        high = np.where(below >= wanted, middle, high)
        low = np.where(below >= wanted, low, middle)


def _factors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Triangular factors, rows swapped for the larger pivot, of the matrix less each of ``values``."""
    n, k = len(diagonal), len(values)
    d = diagonal[:, None] - values
    up, up2 = np.zeros((n, k)), np.zeros((n, k))
    up[: n - 1] = off[:, None]
    factor, swap = np.zeros((n, k)), np.zeros((n, k), bool)
    least = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    for i in range(n - 1):
        swap[i] = np.abs(off[i]) > np.abs(d[i])
        pivot = np.where(swap[i], off[i], np.where(np.abs(d[i]) < least, least, d[i]))
        factor[i] = np.where(swap[i], d[i], off[i]) / pivot
        first, second = np.where(swap[i], d[i + 1], up[i]), np.where(swap[i], up[i], d[i + 1])
        up2[i] = np.where(swap[i], up[i + 1], 0)
        up[i + 1] = np.where(swap[i], -factor[i] * up[i + 1], up[i + 1])
        d[i], up[i], d[i + 1] = pivot, first, second - factor[i] * first
    d[n - 1] = np.where(np.abs(d[n - 1]) < least, least, d[n - 1])
    return d, up, up2, factor, swap


def _solved(factors: tuple[np.ndarray, ...], b: np.ndarray) -> np.ndarray:
    d, up, up2, factor, swap = factors
    x = b.copy()
    n = len(x)
    for i in range(n - 1):
        top, bottom = np.where(swap[i], x[i + 1], x[i]), np.where(swap[i], x[i], x[i + 1])
        x[i], x[i + 1] = top, bottom - factor[i] * top
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= d[i]
        peak = np.abs(x[i:]).max(axis=0)
        x /= np.where(peak > 1e100, peak, 1.0)  # only directions count
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, of falling eigenvalues; orthogonal within clusters."""
    factors = _factors(diagonal, off, values)
    x = np.random.default_rng(7).standard_normal((len(diagonal), len(values)))
    close = CLUSTER * np.abs(values).max(initial=0)
    start = [0] * len(values)
    for j in range(1, len(values)):
        start[j] = start[j - 1] if values[j - 1] - values[j] <= close else j
    for _ in range(ROUNDS):
        x = _solved(factors, x)
        x /= np.abs(x).max(axis=0)
        for j in range(len(values)):
            for _ in range(2):  # once more for what the first time left by rounding
                others = x[:, start[j] : j]
                x[:, j] -= others @ (others.T @ x[:, j])
                x[:, j] /= np.linalg.norm(x[:, j])
    return x


def leading(matrix: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` largest eigenvalues, falling and not zero, and unit vectors, their largest entry positive."""
    diagonal, off, mirrors = tridiagonal(matrix)
    values = largest_values(diagonal, off, min(k, len(matrix)))
    values = values[values > len(matrix) * np.finfo(float).eps * max(values[0], 0)]
    if not len(values):
        return values, np.zeros((len(matrix), 0))
    x = inverse_iteration(diagonal, off, values)
    for at in range(len(mirrors) - 1, -1, -1):
        x[at + 1 :] -= 2 * np.outer(mirrors[at], mirrors[at] @ x[at + 1 :])
    return values, x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(values))])


def fit(rows: DataFrame, k: int = COMPONENTS) -> Fit:
    """The components of the vectors ``v`` that take part."""
    n, sums = _sums(rows)
    if n == 0:
        return Fit(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    near = np.array([round(Decimal(s) / n) for s in sums], np.int64)
    matrix = _covariance(rows, len(sums), len(sums), n, lambda x: (x - near).astype(float))
    values, vectors = leading((matrix + matrix.T) / 2, k)
    return Fit(n, sums, float(np.trace(matrix)), values, vectors)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance, less the identity."""
    k = len(found.values)
    return float(np.abs(_covariance(rows, k, len(found.sums), found.n, found.whitened) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """Per row and component: ``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(rows, k)
    count = len(found.values)
    if count == 0:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, found)
    shared = df.sparkSession.sparkContext.broadcast(vars(found))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Fit(**shared.value)
        for batch in small(batches, ROWS):
            for picked, x in whole_vectors(batch):
                if x.shape[1] != len(model.sums):
                    continue
                each = pa.array(np.repeat(np.arange(len(picked)), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(picked)).take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(picked))),
                        pa.array(np.full(len(picked) * count, model.n)),
                        pa.array(model.deviations(x), pa.int64()).take(each),
                        pa.array(model.whitened(x).ravel()),
                        pa.array(np.tile(model.values / model.trace, len(picked))),
                        pa.array(np.full(len(picked) * count, error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)
