"""Contour integration against a full eigenvalue decomposition, and whitening against a plain loop."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tableferry.llm import feast, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x int, cell int, n int"
SPECTRA = {
    "spread": lambda d, rng: rng.random(d) * 10,
    "equal": lambda d, rng: np.ones(d),
    "two clusters": lambda d, rng: np.r_[np.full(d // 2, 3.0), np.full(d - d // 2, 2.0)],
    "steep": lambda d, rng: 10.0 ** -np.arange(d) * 1e6,
    "none": lambda d, rng: np.zeros(d),
    "near": lambda d, rng: 1 + 1e-9 * np.arange(d),
    "low rank": lambda d, rng: np.r_[5.0, np.zeros(d - 1)],
}


@pytest.mark.parametrize("spectrum", SPECTRA)
@pytest.mark.parametrize("d", [1, 2, 3, 5, 17, 48])
def test_leading_eigenpairs(spectrum, d):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    m = (q * SPECTRA[spectrum](d, rng)) @ q.T
    m = (m + m.T) / 2
    values, vectors = feast.leading(m, 4)
    expected = np.linalg.eigvalsh(m)[::-1][:4]
    scale = max(np.abs(expected).max(), 1e-300)
    assert values.shape == expected.shape and np.abs(values - expected).max() <= 1e-13 * scale
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


def test_inertia_counts_all_eigenvalues_below_zero():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a = rng.standard_normal((9, 9)) * rng.integers(0, 2, (9, 9))
        a = a + a.T - np.diag(np.diag(a)) * rng.integers(0, 3)
        values = np.linalg.eigvalsh(a)
        if np.abs(values).min() > 1e-9:
            assert feast.negative_pivots(a) == (values < 0).sum()


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(RuntimeError):
        feast.in_interval(np.diag([1.0, 2.0, 5.0]), 1.5, 2.5, 2, rounds=8)


def brute(rows):
    kept = [(i, [math.floor(256 * float(np.float32(c))) + 0 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    z = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for x in fit])
    v = z.T @ z / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    out = []
    for i, x in kept:
        at = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
        out += [(i, c + 1, n, deviation, at @ vectors[:, c] / math.sqrt(values[c]), values[c] / np.trace(v)) for c in range(len(values))]
    return out


def same(got, expected):
    got, expected = sorted(got, key=lambda r: (r[0], r[1], r[3], abs(r[4]))), sorted(expected, key=lambda r: (r[0], r[1], r[3], abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    sign = {}
    for a, b in zip(got, expected):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and abs(a[6]) < 1e-9
        assert abs(a[4]) == pytest.approx(abs(b[4]), abs=1e-9)
        if abs(b[4]) > 1e-6:
            assert sign.setdefault(a[1], a[4] * b[4] > 0) == (a[4] * b[4] > 0)


def test_whitening_against_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 7)) * [3, 2, 1.5, 1, 0.5, 0.2, 0.1] + [100, 0, 0, -7, 0, 0, 0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)] + [(5, rows[5][1])]
    bad = [(2000, None), (2001, [1.0] * 6 + [None]), (2002, [math.nan] * 7), (2003, [math.inf] + [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows + bad], SCHEMA).repartition(5)
    same([tuple(r) for r in whitening.whiten(spark, df).collect()], brute(rows))


def test_query_against_a_plain_loop(spark):
    from tableferry.llm.queries import registry

    folder = "/root/testdata/sf0.001"
    got = [tuple(r) for r in registry()["op13_whitening"](spark, folder).collect()]
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    same(got, brute(rows))


def test_odd_tables(spark):
    def run(rows):
        return [tuple(r) for r in whitening.whiten(spark, spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)).collect()]

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, []), (2, [])]) == []
    # Equal vectors vary in nothing.
    assert run([(1, [0.5, -0.5]), (None, [0.5, -0.5])]).count((None, 1, 1, 0, None, None, None)) == 1
    short = run([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0])])
    assert {(r[0], r[2]) for r in short} == {(1, 2), (2, 2), (3, 2)}
    assert [r[4] is None for r in sorted(short) if r[0] == 1] == [False, True]
    # 512 * 512 * ... stays exact, and what no bigint holds is null.
    huge = run([(1, [3e18]), (2, [-3e18]), (3, [0.0])])
    assert all(r[3] is None for r in huge if r[0] < 3) and len(huge) == 3
