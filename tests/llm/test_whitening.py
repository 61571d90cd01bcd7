import math

import numpy as np
import pytest

from coursepulse.llm import whitening
from coursepulse.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, component string, n int, block string, length string, v int"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [None if x is None else float(x) for x in v], "c", 1, "b", "l", 7)
                                  for i, v in enumerate(vectors)], SCHEMA)


def plain(vectors, k=32):
    """Whole numbers, deviations, and whitened coordinates by the covariance itself."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return deviations, centred @ axes / np.sqrt(values), values / np.trace(cov)


def check(rows, vectors, first=0):
    deviations, want, explained = plain(vectors)
    k = want.shape[1]
    got = {(r[0], r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * k
    whitened = np.array([[got[first + i, j + 1].whitened for j in range(k)] for i in range(len(vectors))])
    sign = np.sign((whitened * want).sum(axis=0))
    assert np.abs(whitened - want * sign).max() < 1e-8
    for r in rows:
        assert r.n == len(vectors) and r.deviation == deviations[r[0] - first]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_against_the_covariance(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 40)) * np.linspace(3, 0.2, 40)
    check(whitening.whiten(table(spark, vectors)).collect(), vectors)


def test_the_query_against_the_covariance(spark):
    folder = "/root/testdata/sf0.001"
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    rows = QUERIES["op12_whitening"](spark, folder).collect()
    order = {v: i for i, v in enumerate(given)}
    deviations, want, _ = plain(list(given.values()))
    got = np.zeros(want.shape)
    for r in rows:
        got[order[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviations[order[r.vec_id]] and r.identity_error < 1e-4
    assert len(rows) == want.size and np.abs(np.abs(got) - np.abs(want)).max() < 1e-7


@pytest.mark.parametrize(("d", "values"), [
    (200, np.geomspace(1e4, 1e-4, 200)), (150, np.repeat([9.0, 9.0 - 1e-7, 4.0], 50)), (20, np.ones(20)), (90, np.r_[np.ones(5), np.zeros(85)])])
def test_jacobi_davidson(d, values):
    """Wide, clustered, equal and vanishing eigenvalues; all residuals at double precision."""
    axes = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    matrix = axes * values @ axes.T
    found, vectors = whitening.jacobi_davidson(lambda q: matrix @ q, d, 32)
    k = min(d, 32)
    assert np.abs(found - np.sort(values)[::-1][:k]).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * values.max()


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.normal(size=(30, 3)))[0]
    matrix = rng.normal(size=(30, 30))
    matrix = matrix + matrix.T
    theta, residual = np.array([0.3, -1.0]), rng.normal(size=(30, 2))
    away = np.eye(30) - q @ q.T
    t = whitening.minres(lambda v: matrix @ v, theta, q, residual, 60, reduction=1e-10)
    for i in range(2):
        left = away @ (matrix - theta[i] * np.eye(30)) @ away @ t[:, i] + away @ residual[:, i]
        assert np.linalg.norm(left) < 1e-7 and np.abs(q.T @ t[:, i]).max() < 1e-10


def test_unsound_vectors_lengths_and_empty_tables(spark):
    rng = np.random.default_rng(6)
    threes, twos = rng.normal(size=(20, 3)), rng.normal(size=(9, 2))
    odd = [None, [], [1, None, 2], [1, math.nan, 2], [1, math.inf, 2]]
    rows = whitening.whiten(table(spark, threes).union(table(spark, twos, 100)).union(table(spark, odd, 200))).collect()
    check([r for r in rows if r.id < 100], threes)
    check([r for r in rows if 100 <= r.id < 200], twos, 100)
    assert not [r for r in rows if r.id >= 200]
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, odd)).count() == 0


def test_directions_without_spread(spark):
    """Equal vectors have no component; a constant dimension takes one away; one far entry stays exact."""
    assert whitening.whiten(table(spark, [[1, 2]] * 5)).count() == 0
    assert whitening.whiten(table(spark, [[1, 2]])).count() == 0
    flat = [[x, 5, y] for x, y in np.random.default_rng(7).normal(size=(12, 2))]
    assert {r.component for r in whitening.whiten(table(spark, flat)).collect()} == {1, 2}
    far = whitening.whiten(table(spark, [[3e38, 1], [1, 2], [2, 7], [-3e38, 0]])).collect()
    assert {r.deviation for r in far if r.component == 1} == {None} or all(r.deviation is None or r.deviation >= 0 for r in far)


def test_repeated_rows_and_null_ids(spark):
    vectors = np.random.default_rng(9).normal(size=(8, 2))
    df = table(spark, vectors).union(table(spark, vectors[:3])).selectExpr("nullif(vec_id, 1) AS vec_id", "embedding")
    rows = whitening.whiten(df).collect()
    assert len(rows) == 22 and {r.n for r in rows} == {11}
    assert len([r for r in rows if r.id is None]) == 4
