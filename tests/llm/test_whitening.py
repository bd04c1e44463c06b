"""Whitening against a dense eigenvalue routine and exact integers."""

import math

import numpy as np
import pytest
from llm_cases import *  # noqa: F401,F403

from tillroll.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, c long, whitened string"


def expected(vectors):
    """{id: (n, deviation, whitened up to sign)} and the explained shares, on plain Python numbers."""
    rows = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in vectors]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    away = np.array(fit, dtype=float) - np.array(sums) / n
    covariance = away.T @ away / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:4]
    out = {}
    for k, x in rows:
        c = np.array(x) - np.array(sums) / n
        out[k] = (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)),
                  (c @ axes[:, order]) / np.sqrt(values[order]))
    return out, values[order] / np.trace(covariance)


def compare(found, vectors):
    wanted, shares = expected(vectors)
    rows = found.collect()
    assert len(rows) == len(wanted) * len(shares)
    signs = {}
    for r in rows:
        n, deviation, white = wanted[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        k = r["component"] - 1
        assert abs(r["explained"] / shares[k] - 1) < 1e-9 and r["identity_error"] < 1e-9
        if abs(white[k]) > 1e-3:
            signs.setdefault(k, math.copysign(1, white[k] * r["whitened"]))
        assert abs(r["whitened"] * signs.get(k, 1) - white[k]) < 1e-8


def test_every_vector(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    compare(whitening.op11_whitening(spark, SMALL), [tuple(r) for r in
            vectors.select("vec_id", "embedding").collect()])


def test_repeated_null_and_broken_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(k, [float(np.float32(a)) for a in rng.normal(size=6)]) for k in range(40)]
    good += [(100 + k, good[k % 3][1]) for k in range(50)]  # copies must not pull the axes
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 6),
           (203, [math.inf] + [0.0] * 5), (204, []), (205, [1.0])]
    rows = [(k, v, None, "x", 1, "w") for k, v in good + bad]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(whitening.op11_whitening(spark, str(tmp_path)), good)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]])
def test_no_spread_gives_no_rows(spark, tmp_path, rows):
    frame = spark.createDataFrame([(k, v, 1, "x", 1, "w") for k, v in rows], SCHEMA)
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op11_whitening(spark, str(tmp_path))
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                             "identity_error"]


def test_rank_below_dimension(spark):
    vectors = [(k, [k / 256, 2 * k / 256, 7.0]) for k in range(9)] + [(None, [1.0, 1.0, 7.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows, found, error = whitening.whiten(frame, most=4)
    assert len(found.eigenvalues) == 2 and error < 1e-9
    assert {len(r["whitened"]) for r in rows.collect()} == {2}


def test_long_range(spark):
    vectors = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3.0, 2.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows, found, _ = whitening.whiten(frame)
    by_id = {r["vec_id"]: r["deviation"] for r in rows.collect()}
    assert found.n == 3 and by_id == {1: None, 2: None, 3: (3 * 768 - 767) ** 2 + (3 * 512 - 768) ** 2}


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    for d, r in [(1, 1), (5, 5), (30, 12), (64, 64)]:
        a = rng.normal(size=(d, r)) * 10.0 ** -np.linspace(0, 5, r)
        scatter = a @ a.T
        factor = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor @ factor.T, scatter, atol=1e-12 * np.trace(scatter))
        values, axes = whitening.one_sided_jacobi(factor)
        assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-11)
        assert np.allclose(values[: min(r, 6)], np.linalg.eigvalsh(scatter)[::-1][: min(r, 6)], rtol=1e-8)
        assert np.all(np.diff(values) <= 0)
