import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepulse.llm import catalogue, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def vectors(n=300, d=40, seed=1):
    chance = np.random.default_rng(seed)
    x = chance.standard_normal((n, 6)) @ chance.standard_normal((6, d)) + 0.2 * chance.standard_normal((n, d)) + 3
    return x.astype("f4").astype(float)


def whole(values):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in values]


def by_hand(xs, k=32):
    """n, sums, trace, eigenvalues and vectors of whole vectors, by numpy's own solver."""
    x = np.array(xs, dtype=float)
    own = x - x.mean(axis=0)
    cov = own.T @ own / len(x)
    values, found = np.linalg.eigh(cov)
    return own, np.trace(cov), values[::-1][:k], found[:, ::-1][:, :k]


def check(rows, ids, values, k=32):
    xs = whole(values)
    own, trace, eigen, found = by_hand(xs, k)
    n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
    at = {i: p for p, i in enumerate(ids)}
    assert len(rows) == n * len(eigen)
    got = np.zeros((n, len(eigen)))
    for r in rows:
        p = at[r.vec_id]
        got[p, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(xs[p], sums, strict=True))
        assert r.explained == pytest.approx(eigen[r.component - 1] / trace, rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    want = own @ found / np.sqrt(eigen)
    signs = np.sign((want * got).sum(axis=0))
    assert np.abs(want * signs - got).max() < 1e-7


def test_whitening_equals_a_dense_solver(spark):
    values = vectors()
    df = spark.createDataFrame([(i, v.tolist(), "x", "y") for i, v in enumerate(values)], SCHEMA).repartition(5)
    check(whitening.whiten(df).collect(), range(len(values)), values)


def test_odd_rows_take_no_part_and_ids_may_repeat(spark):
    values = vectors(60, 7)
    rows = [(i // 2 if i < 40 else None, v.tolist(), "x", "y") for i, v in enumerate(values)]
    odd = [None, [], [1.0] * 6 + [None], [float("nan")] + [1.0] * 6, [float("inf")] * 7, [1.0] * 6, [1.0] * 8, [3e38] * 7]
    df = spark.createDataFrame(rows + [(900 + i, v, None, None) for i, v in enumerate(odd)], SCHEMA)
    got = whitening.whiten(df).collect()
    assert len(got) == 60 * 7 and {r.n for r in got} == {60}
    assert {r.vec_id for r in got} == {r[0] for r in rows}
    own, _, eigen, found = by_hand(whole(values))
    size = np.abs(own @ found / np.sqrt(eigen))
    assert sorted(abs(r.whitened) for r in got) == pytest.approx(sorted(size.ravel()), abs=1e-8)


def test_no_scale_no_component(spark):
    same = [(i, [0.5, 2.0, -1.0], None, None) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame(same[:1], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    flat = [(i, [float(i), float(-2 * i), 7.0], None, None) for i in range(5)]  # one direction only
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)


def test_deviation_that_fits_no_long_is_null(spark):
    rows = [(0, [2.0**38, 0.0], None, None), (1, [-(2.0**38), 0.5], None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.deviation for r in got} == {None} and {r.component for r in got} == {1}


def orthogonal(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0]


@pytest.mark.parametrize("values", [
    [5.0] * 40, [1.0] * 20 + [3.0] * 20, [1 + 1e-9 * i for i in range(40)], [10.0**-i for i in range(12)],
    list(range(1, 65)), [7.0], [2.0, 2.0], [100.0, 100.0 - 1e-10, *range(30)], [1 + 1e-4 * i for i in range(50)],
])
def test_eigenvectors_in_clusters(values):
    q = orthogonal(len(values), 3)
    matrix = (q * values) @ q.T
    got, vectors = whitening.leading((matrix + matrix.T) / 2)
    want = sorted((v for v in values if v > 1e-14 * max(values)), reverse=True)[:32]
    assert got == pytest.approx(want, rel=1e-9, abs=1e-13 * max(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-10 * max(values)


def test_diagonal_matrix_falls_apart():
    got, vectors = whitening.leading(np.diag([3.0, 1.0, 3.0, 2.0]))
    assert got == pytest.approx([3, 3, 2, 1]) and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
    assert np.abs(np.diag([3.0, 1.0, 3.0, 2.0]) @ vectors - vectors * got).max() < 1e-12


def test_centre_keeps_its_digits():
    sums = [10**15 + 1, -(10**14)]
    fit = whitening.Fit(3, sums, 1.0, np.ones(2), np.eye(2))
    x = np.array([[333333333333333, -33333333333333]])
    want = [float(Decimal(a) - Decimal(s) / 3) for a, s in zip(x[0].tolist(), sums, strict=True)]
    assert fit.centred(x)[0].tolist() == pytest.approx(want, rel=1e-12)


def test_same_result_over_other_partitions(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    one, other = (whitening.whiten(d).orderBy("vec_id", "component").collect() for d in (df.coalesce(1), df.repartition(7)))
    assert [tuple(r)[:4] for r in one] == [tuple(r)[:4] for r in other]
    assert [r.whitened for r in one] == pytest.approx([r.whitened for r in other], abs=1e-9)


def test_query_on_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    random.Random(2).shuffle(rows)
    got = catalogue.QUERIES["op11_whitening"](spark, sf_dir)
    assert got.where(F.col("identity_error") > 1e-4).isEmpty()
    check(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])
