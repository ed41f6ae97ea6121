import math

import numpy as np
import pytest

from conftest import SF
from trawl.llm.queries import QUERIES
from trawl.llm.whitening import Whitening, eigen, one_sided_jacobi, pivoted_cholesky, whiten

COLUMNS = "vec_id long, embedding array<float>, component string, n string"


def brute(vectors):
    """n, sums, deviations, whitened up to sign, explained; by numpy's own eigenvectors."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    apart = fit - sums / n
    covariance = apart.T @ apart / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:16], directions[:, ::-1][:, :16]
    return (n, [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x],
            (x - sums / n) @ directions / np.sqrt(values), values / covariance.trace())


@pytest.mark.parametrize("spread", [0, -3, -6])
def test_eigen_equals_numpy(spread):
    rnd = np.random.default_rng(1)
    a = rnd.normal(size=(200, 33)) @ np.diag(np.logspace(0, spread, 33))
    a = a.T @ a
    values, vectors = eigen(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-9, atol=1e-16)
    assert np.abs(vectors.T @ vectors - np.eye(33)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * values[0]


def test_factor_and_rank():
    rnd = np.random.default_rng(2)
    a = rnd.normal(size=(9, 4))
    a = a @ a.T
    factor, order = pivoted_cholesky(a)
    assert factor.shape == (9, 4) and np.allclose(factor @ factor.T, a[np.ix_(order, order)])
    assert np.allclose(np.tril(factor), factor)
    turned = one_sided_jacobi(factor)
    cross = turned.T @ turned
    assert np.allclose(turned @ turned.T, factor @ factor.T) and np.abs(cross - np.diag(cross.diagonal())).max() < 1e-12
    assert pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0) and len(eigen(np.zeros((0, 0)))[0]) == 0


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_whole_table(spark, sf):
    folder = SF.replace("0.001", sf)
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, whitened, explained = brute([r["embedding"] for r in table])
    rows = sorted(QUERIES["op13_embedding_whitening"](spark, folder).collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"]) for r in rows] == [(t["vec_id"], c) for t in table for c in range(1, 17)]
    assert {r["n"] for r in rows} == {n} and [r["deviation"] for r in rows[::16]] == deviations
    got = np.array([r["whitened"] for r in rows]).reshape(-1, 16)
    assert np.abs(got * np.sign((got * whitened).sum(0)) - whitened).max() < 1e-9
    assert np.allclose([r["explained"] for r in rows[:16]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_rows_of_every_kind(spark):
    rnd = np.random.default_rng(3)
    good = [(i, [float(v) for v in rnd.normal(size=5)]) for i in range(40)]
    hot = [(100 + i, good[0][1]) for i in range(60)]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [math.nan] * 5), (204, [math.inf] * 5),
           (205, [1.0, 2.0]), (206, [3e38] * 5)]
    rows = good + hot + [(None, good[1][1]), good[2]]
    frame = spark.createDataFrame([(*r, "old", "old") for r in rows + odd], COLUMNS)
    found = whiten(frame)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    assert len(got) == 5 * len(rows) and {r["n"] for r in got} == {40}
    assert len({r["whitened"] for r in got if r["component"] == 1 and (r["vec_id"] == 0 or (r["vec_id"] or 0) >= 100)}) == 1
    assert abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1e-12


def test_without_variance_or_rows(spark):
    make = lambda rows: spark.createDataFrame([(*r, "a", "b") for r in rows], COLUMNS)
    assert whiten(make([])).count() == 0
    assert whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # One direction alone varies, with copies of all rows.
    rows = whiten(make([(i, [float(i % 4), 2.0 * (i % 4), 7.0]) for i in range(12)])).collect()
    assert {r["component"] for r in rows} == {1} and abs(rows[0]["explained"] - 1) < 1e-12 and {r["n"] for r in rows} == {4}


def test_sums_beyond_a_long():
    model = Whitening(10 ** 12, [10 ** 19, 10 ** 19], 1.0, np.ones(1), np.eye(2)[:, :1])
    x = np.array([[10 ** 7, 10 ** 7], [10 ** 7 + 9, 10 ** 7]])
    assert model.deviations(x) == [0, None]
    assert Whitening(10 ** 9, [10 ** 15, 0], 1.0, np.ones(1), np.eye(2)[:, :1]).deviations(
        np.array([[10 ** 6 + 2, 1]])) == [4 * 10 ** 18 + 10 ** 18]
