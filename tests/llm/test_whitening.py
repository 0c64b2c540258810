"""Whitening against plain linear algebra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from atmolake.llm import whitening
from tests.llm.conftest import SF_DIR


def brute(rows):
    """(vec_id, deviation, whitened up to sign), explained of numpy's eigenvectors."""
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    y = fit - sums / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = values[:4] > 1e-12 * values[0]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, deviation, ((x - sums / n) @ vectors[:, :4] / np.sqrt(np.maximum(values[:4], 1e-300)))[:, keep], values[:4][keep] / np.trace(cov)


def compare(spark, rows, schema="vec_id long, embedding array<double>", tolerance=1e-9, **more):
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = whitening.whitened(df, **more).collect()
    used = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    n, deviation, white, explained = brute(used)
    assert len(got) == white.size
    table = {(r["vec_id"], r["component"]): r for r in got}
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for c in range(white.shape[1]):
        mine = np.array([table[r[0], c + 1]["whitened"] for r in used])
        sign = np.sign(mine @ white[:, c])
        np.testing.assert_allclose(mine, sign * white[:, c], atol=tolerance)
    for (vec_id, _), d in zip(used, deviation):
        assert table[vec_id, 1]["deviation"] == d
    np.testing.assert_allclose([table[used[0][0], c + 1]["explained"] for c in range(white.shape[1])], explained, rtol=1e-10)


def test_query_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compare(spark, rows, "vec_id long, embedding array<float>")


def test_odd_vectors(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(c) for c in random.standard_normal(5) * [1, 2, 3, 4, 5]]) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(200, None), (201, [math.nan] + [1.0] * 4), (202, [math.inf] + [1.0] * 4), (203, [None] + [1.0] * 4), (204, [])]
    rows += [(205, [-0.0] * 5), (206, [1e-300, -1e-300, 0.5, -0.5, 2.0])]
    compare(spark, rows)
    odd = spark.createDataFrame([*rows, (300, [1.0, 2.0]), (301, [1e300] * 5)], "vec_id long, embedding array<double>")
    assert not {300, 301} & {r["vec_id"] for r in whitening.whitened(odd).collect()}


def test_few_directions(spark):
    """Vectors on a line have one component; one vector has none; no table has no rows."""
    line = [(i, [float(i), 2.0 * i, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]
    compare(spark, line)
    df = spark.createDataFrame(line, "vec_id long, embedding array<double>")
    assert whitening.whitened(df.limit(1)).count() == 0 and whitening.whitened(df.limit(0)).count() == 0
    short = [(i, [float(i * i % 7), float(i)]) for i in range(9)]
    compare(spark, short)


def test_truncated_spectra_are_refined(spark):
    """With fewer directions than dimensions the Rayleigh-Ritz steps still give the components themselves."""
    random = np.random.default_rng(4)
    scale = 8.0 * 0.8 ** np.arange(40)
    turn = np.linalg.qr(random.standard_normal((40, 40)))[0]
    rows = [(i, [float(c) for c in (random.standard_normal(40) * scale) @ turn]) for i in range(300)]
    compare(spark, rows, rank=8, tolerance=1e-7)


def test_result_does_not_hang_on_partitions_or_names(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").selectExpr("vec_id", "embedding", "label AS x", "1 AS component")
    a, b = ({(r["vec_id"], r["component"]): r for r in whitening.whitened(df.repartition(k)).collect()} for k in (1, 7))
    assert a.keys() == b.keys()
    assert max(abs(a[k]["whitened"] - b[k]["whitened"]) for k in a) < 1e-9


def test_deviation_beyond_long_is_null():
    x = np.array([[1 << 40, 0], [0, 1]])
    assert whitening._deviations(x, 1 << 20, [1 << 40, 1]) == [None, None]
    assert whitening._deviations(np.array([[3], [5]]), 2, [8]) == [4, 4]


@pytest.mark.parametrize("kind", range(5))
def test_rank_one_update(kind):
    random = np.random.default_rng(kind)
    for _ in range(200):
        k = random.integers(1, 20)
        values = np.sort(np.abs(random.standard_normal(k))) * 10.0 ** random.integers(-3, 4)
        values = [values, np.round(values), np.ones(k), np.sort(values * 10.0 ** random.integers(-12, 3, k)), values][kind]
        z = random.standard_normal(k) * 10.0 ** random.integers(-4, 3)
        if kind == 4:
            z *= 10.0 ** random.integers(-14, 1, k)
        z[random.integers(0, k)] *= random.integers(0, 2)
        w, q = whitening.rank_one(values, z)
        a = np.diag(values) + np.outer(z, z)
        assert np.abs(q.T @ q - np.eye(k)).max() < 1e-13 * k
        assert np.abs(a @ q - q * w).max() <= 1e-13 * k * np.abs(a).max()
        assert (np.diff(w) >= 0).all()


def test_combined_spectra_equal_one():
    x = np.floor(256 * np.random.default_rng(1).standard_normal((90, 6)))
    parts = [whitening.Spectrum(6) for _ in range(3)]
    for i, v in enumerate(x[:60]):
        parts[i % 3].add(v)
    parts[1].add_block(x[60:85])
    parts[2].add_block(x[85:])
    for part in parts[1:]:
        parts[0].combine(whitening.Spectrum.unpack(np.array(part.pack()), 6, 128))
    y = x - x.mean(0)
    np.testing.assert_allclose(parts[0].values, np.linalg.eigvalsh(y.T @ y), rtol=1e-11)
    np.testing.assert_allclose(parts[0].mean, x.mean(0), atol=1e-10)
