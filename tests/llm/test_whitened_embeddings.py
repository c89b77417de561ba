"""Whitening against numpy's double-precision solver."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def expected(vectors):
    """Grid, sums, components and coordinates in one go, all rows held."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(axis=0)
    y = (once - sums // n) - (sums % n) / n
    covariance = y.T @ y / n
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1][:16], columns[:, ::-1][:, :16]
    coordinates = ((x - sums // n) - (sums % n) / n) @ columns / np.sqrt(values)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, coordinates, exact, values / np.trace(covariance)


def agrees(rows, ids, vectors):
    n, coordinates, exact, share = expected(vectors)
    k = coordinates.shape[1]
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(got) == len(ids) * k
    table = np.array([[got[i, c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((table * coordinates).sum(axis=0))
    assert np.abs(table * signs - coordinates).max() < 1e-8
    assert {(r.vec_id, r.n, r.deviation) for r in rows} == {(i, n, d) for i, d in zip(ids, exact, strict=True)}
    assert all(abs(got[ids[0], c + 1].explained - share[c]) < 1e-9 for c in range(k))
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query_matches_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    agrees(QUERIES["op13_refined_whitening"](spark, SMALL).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def spectra(size):
    half = size // 2
    yield "spread", np.linspace(1, 10, size)
    yield "close", np.r_[np.ones(half) + 1e-9 * np.arange(half), 3 + 1e-6 * np.arange(size - half)]
    yield "equal", np.r_[np.ones(half), np.arange(2, 2 + size - half)]
    yield "rank", np.r_[np.zeros(half), np.arange(1, size - half + 1)]
    yield "nothing", np.zeros(size)


@pytest.mark.parametrize("size", [1, 2, 40, 200])
def test_eigenvectors_are_refined_to_double_precision(size):
    basis = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
    for name, spectrum in spectra(size):
        matrix = 64 * (basis * spectrum) @ basis.T
        matrix = (matrix + matrix.T) / 2
        values, columns = whitening.refined_eigenvectors(matrix)
        norm = np.abs(matrix).max() or 1.0
        assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1]).max() < 1e-12 * norm * size, name
        assert np.abs(columns.T @ columns - np.eye(size)).max() < 1e-13 * size, name
        assert np.abs(matrix @ columns - columns * values).max() < 1e-13 * norm * size, name


def test_a_float32_solver_alone_would_not_do():
    """The vectors of two eigenvalues that float32 cannot tell apart."""
    basis = np.linalg.qr(np.random.default_rng(5).normal(size=(20, 20)))[0]
    spectrum = np.r_[np.arange(3, 21), 1.0, 1.0 + 1e-9]
    values, columns = whitening.refined_eigenvectors((basis * spectrum) @ basis.T)
    assert abs(values[-2] - values[-1] - 1e-9) < 1e-13
    assert abs(abs(columns[:, -2] @ basis[:, 19]) - 1) < 1e-6
    alone = whitening._single((basis * spectrum) @ basis.T)
    assert np.abs(alone.T @ alone - np.eye(20)).max() > 1e-9


def test_nulls_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    plain = rng.normal(size=(40, 3)).tolist()
    good = [(k, v) for k, v in enumerate(plain)] + [(100, plain[0]), (100, plain[0]), (101, [1e-3, 1e-3, 1e-3]), (None, plain[1])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 0.0]), (203, [float("inf"), 0.0, 0.0]), (204, [])]
    schema = "vec_id long, embedding array<double>, x string, n int"
    df = spark.createDataFrame([(*r, "mine", 1) for r in good + bad], schema)
    rows = whitening.whitened(df).collect()
    assert len(rows) == 3 * len(good)
    n, coordinates, exact, _ = expected([v for _, v in good])
    got = sorted((repr(r.vec_id), r.component, round(abs(r.whitened), 7), r.deviation, r.n) for r in rows)
    want = sorted(
        (repr(i), c + 1, round(abs(row[c]), 7), d, n) for (i, _), row, d in zip(good, coordinates, exact, strict=True) for c in range(3)
    )
    assert got == want and n == 41


def test_without_variance_and_without_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    }
    line = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.0, 0.0])], schema)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-12
    none = whitening.whitened(spark.createDataFrame([], schema))
    assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert none.count() == 0


def test_lengths_and_large_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [2.0, 2.0]), (4, [1e300, -1e300, 0.0]), (5, [0.0, 1.0, 2.0]), (6, [3.0])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, r.n) for r in got} == {(1, 3), (2, 3), (3, 3), (4, 2), (5, 2), (6, 1)}
    assert all(r.deviation is None for r in got if r.vec_id in (4, 5))
    assert sum(1 for r in got if r.vec_id == 4) == 3
