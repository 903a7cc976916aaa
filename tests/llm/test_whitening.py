import numpy as np
import pytest
from pyspark.sql import functions as F

from regiobank.llm import whitening
from regiobank.llm.queries import op13_whitening


def brute_force(vectors, most=32):
    """vec_id -> (deviation, whitened up to signs), eigenvalues, explained, n; by a dense eigendecomposition."""
    fine = [(i, v) for i, v in vectors if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(64 * np.array(v, dtype=np.float64)) for _, v in fine]) + 1000000
    exact = x.astype(np.int64).astype(object)
    n, sums = len(fine), exact.sum(0)
    centred = x - (sums / n).astype(np.float64)
    covariance = centred.T @ centred / n
    e, vectors = np.linalg.eigh(covariance)
    e, vectors = e[::-1], vectors[:, ::-1]
    rank = min(most, int(np.sum(e > 1e-9 * e[0])))
    return {
        "ids": [i for i, _ in fine],
        "n": n,
        "deviation": ((n * exact - sums) ** 2).sum(1).tolist(),
        "white": centred @ vectors[:, :rank] / np.sqrt(e[:rank]),
        "explained": e[:rank] / np.trace(covariance),
        "e": e,
    }


def check(rows, wanted):
    size = wanted["white"].shape[1]
    assert len(rows) == wanted["n"] * size
    at = {i: k for k, i in enumerate(wanted["ids"])}
    got = np.full((wanted["n"], size), np.nan)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == wanted["n"] and r.deviation == wanted["deviation"][at[r.vec_id]]
        assert r.explained == pytest.approx(wanted["explained"][r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    signs = np.sign((got * wanted["white"]).sum(0))
    assert np.abs(got * signs - wanted["white"]).max() < 1e-6
    assert np.abs(np.cov(got.T, bias=True) - np.eye(size)).max() < 1e-9


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, y string, n int, whitened double")


def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(op13_whitening(spark, folder).collect(), brute_force(rows))


@pytest.mark.parametrize("size,n,most", [(1, 5, 32), (3, 40, 2), (48, 30, 32), (40, 300, 32)])
def test_made_up_vectors(spark, size, n, most):
    rng = np.random.default_rng(size + n)
    rows = [(i, (rng.standard_normal(size) * np.linspace(0.5, 9, size) + 50).astype(np.float32).tolist()) for i in range(n)]
    rows += [(9001, None), (9002, []), (9003, [float("nan")] * size), (9004, [float("-inf")] + rows[0][1][1:]), (9005, [None] + rows[0][1][1:])]
    rows += [(9006, rows[3][1]), (9007, rows[3][1])]
    check(whitening.whiten(table(spark, rows).repartition(4), most).collect(), brute_force(rows, most))


def test_steep_spectrum_stops_early(spark):
    rng = np.random.default_rng(1)
    size = 60
    scale = 1000.0 / 2.0 ** np.arange(size)
    rows = [(i, (rng.standard_normal(size) * scale).astype(np.float32).tolist()) for i in range(200)]
    steps = []
    right = whitening._summed

    def counted(table, work, kind="double"):
        steps.append(kind)
        return right(table, work, kind)

    whitening._summed = counted
    try:
        check(whitening.whiten(table(spark, rows), 5).collect(), brute_force(rows, 5))
    finally:
        whitening._summed = right
    assert len(steps) < 45


def test_equal_eigenvalues():
    """The cross polytope has one eigenvalue; a single start vector alone would find one component."""
    points = np.vstack([np.eye(6), -np.eye(6), np.zeros((1, 6))])
    v, b = whitening.bidiagonalise(lambda p: points.T @ (points @ p), 6, lambda *_: False)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-12)
    assert np.allclose(np.linalg.svd(b)[1], np.sqrt(2))
    gram = points.T @ points
    assert np.allclose(v.T @ gram @ v, b.T @ b, atol=1e-12)


def test_low_rank():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((50, 3)) @ rng.standard_normal((3, 10))
    v, b = whitening.bidiagonalise(lambda p: points.T @ (points @ p), 10, lambda *_: False)
    assert np.allclose(np.linalg.svd(b)[1], np.linalg.svd(points)[1], atol=1e-6)
    assert np.allclose(v.T @ v, np.eye(10), atol=1e-12)


def test_exact_deviations():
    y = np.array([[1 << 40, -(1 << 40)], [3, 4]])
    n, sums = 10**6, [(1 << 40) + 3, 4 - (1 << 40)]
    got = whitening._deviations(y, n, sums)
    wanted = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in y.tolist()]
    assert got == [w if w < 1 << 63 else None for w in wanted] and got[0] is None
    assert whitening._deviations(y[1:], 2, [3, 4]) == [9 + 16]


def test_defined_results(spark):
    equal = table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert whitening.whiten(equal).collect() == []
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    mixed = table(spark, [(1, [0.5, 0.25]), (None, [0.5, 1.25]), (3, [4.0]), (4, [3e38, 1.0])])
    rows = whitening.whiten(mixed).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in rows if r.vec_id) == [(1, 1, 2, 64 * 64)]
    assert len(rows) == 2 and {round(abs(r.whitened), 9) for r in rows} == {1.0}
    big = whitening.usable_rows(table(spark, [(i, [float(2**40), float(i)]) for i in range(3)]).repartition(3))
    assert big.n == 3 and big.sums == [3 * 2**46, 64 * 3]
    assert big.table.select(F.max(F.col("y")[0])).first()[0] == 2**46
