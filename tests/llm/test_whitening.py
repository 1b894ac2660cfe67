import numpy as np
import pytest
from awkward import given

from marlstone.llm import whitening
from marlstone.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, id long, x string, component int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2)
         for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def scaled(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def expected(vectors):
    """x, n, sums, and the leading eigenpairs by numpy."""
    x = scaled(vectors)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    covariance = np.cov((fit - sums / n).T, bias=True).reshape(x.shape[1], -1)
    values, turn = np.linalg.eigh(covariance)
    return x, n, sums, values[::-1], turn[:, ::-1], np.trace(covariance)


def compare(rows, ids, vectors, k):
    x, n, sums, values, turn, trace = expected(vectors)
    got = sorted(rows, key=lambda r: (r["id"], r["component"]))
    order = np.argsort(ids, kind="stable")
    assert [(r["id"], r["component"]) for r in got] == [(ids[i], c) for i in order for c in range(1, k + 1)]
    assert {r["n"] for r in got} == {n}
    exact = [int(s) for s in ((n * x.astype(object) - sums) ** 2).sum(axis=1)]
    assert [r["deviation"] for r in got[::k]] == [exact[i] for i in order]
    whitened = np.array([r["whitened"] for r in got]).reshape(-1, k)
    known = ((x - sums / n) @ turn[:, :k] / np.sqrt(values[:k]))[order]
    signs = np.sign((whitened * known).sum(axis=0))
    assert np.abs(whitened - known * signs).max() < 1e-8
    assert np.allclose([r["explained"] for r in got[:k]], values[:k] / trace, rtol=1e-12)
    assert got[0]["identity_error"] < 1e-10 and len({r["identity_error"] for r in got}) == 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whole_query_against_numpy(spark, sf):
    given_rows = given(f"/root/testdata/{sf}", "embeddings", "vec_id, embedding")
    rows = QUERIES["op13_whitening"](spark, f"/root/testdata/{sf}").withColumnRenamed("vec_id", "id").collect()
    compare(rows, [i for i, _ in given_rows], [v for _, v in given_rows], 16)


def test_repeats_count_once_in_the_fit_and_bad_vectors_go(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(40, 5)).astype(np.float32).tolist()
    vectors = [*good, *[good[0]] * 30, *good[:10]]
    bad = [None, [1, 2, None, 4, 5], [1, 2, float("nan"), 4, 5], [1, 2, float("inf"), 4, 5],
           [float("-inf")] * 5, [], [1, 2, 3]]
    df = frame(spark, [*bad, *vectors], [*range(-len(bad), 0), *range(len(vectors))])
    compare(whitening.whiten(df).collect(), list(range(len(vectors))), vectors, 5)


def test_fewer_components_than_sixteen(spark):
    rng = np.random.default_rng(3)
    flat = rng.normal(size=(30, 2)) @ np.array([[1, 0, 1, 0], [0, 1, 0, 0]])
    rows = whitening.whiten(frame(spark, (np.floor(64 * flat) / 64).tolist())).collect()
    assert {r["component"] for r in rows} == {1, 2}
    assert whitening.whiten(frame(spark, [[1, 2, 3]] * 5)).count() == 0
    assert whitening.whiten(frame(spark, [None, []])).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_and_missing_ids(spark):
    rows = whitening.whiten(frame(spark, [[0, 1], [1, 0], [2, 2], [0, 0]], [1, 1, None, 7])).collect()
    assert sorted((r["id"] is not None, r["id"] or 0) for r in rows) == [(False, 0)] * 2 + [(True, 1)] * 4 + [(True, 7)] * 2


def test_very_large_entries_stay_exact_or_are_null(spark):
    vectors = [[2.0 ** 40, 0], [0, 2.0 ** 40], [1, 1], [3e38, -3e38], [0, 0]]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert {r["id"] for r in rows} == set(range(5)) and all(np.isfinite(r["whitened"]) for r in rows)
    assert all(r["deviation"] is None for r in rows)
    vectors = [[2.0 ** 20, 0], [0, 2.0 ** 20], [1, 1]]
    compare(whitening.whiten(frame(spark, vectors)).collect(), [0, 1, 2], vectors, 2)


@pytest.mark.parametrize("name", ["dense", "wide", "equal", "low rank", "steep", "tiny"])
def test_jacobi_davidson_reaches_double_precision(name):
    rng = np.random.default_rng(7)
    matrix = {
        "dense": np.cov(rng.normal(size=(3000, 64)).T), "wide": np.cov(rng.normal(size=(3000, 300)).T),
        "equal": np.diag([5.0] * 8 + [1.0] * 100), "low rank": np.diag(np.r_[np.ones(10), np.zeros(50)]),
        "steep": np.diag(10.0 ** -np.arange(64.0)), "tiny": np.array([[2.0, 1.0], [1.0, 2.0]]),
    }[name]
    calls = []

    def product(t):
        calls.append(t.shape[1])
        return matrix @ t

    values, vectors = whitening.leading(product, len(matrix), 16)
    known = np.linalg.eigvalsh(matrix)[::-1][:16]
    assert np.abs(values - known).max() <= 1e-13 * known[0]
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * known[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert max(calls) <= 20  # blocks, never the whole matrix
