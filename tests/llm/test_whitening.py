from fractions import Fraction
import math

import numpy as np
import pytest

from quipu.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n long, component string"


def plain(vectors, components=32):
    """n, deviations, whitened, explained by exact fractions and one eigh."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1], vecs[:, ::-1]
    white = np.array([[c / n for c in r] for r in y]) @ vecs[:, :components] / np.sqrt(values[:components])
    return n, [sum(c * c for c in r) for r in y], white, values / np.trace(v)


def rows(rng, n=200, d=40):
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 5
    return [[float(c) for c in r] for r in base]


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 1, "x") for i, v in enumerate(vectors)], SCHEMA)


def test_against_exact_fractions(spark):
    good = rows(np.random.default_rng(1))
    bad = [None, [1.0, None] + [0.0] * 38, [float("nan")] * 40, [float("inf")] + [0.0] * 39, [1.0] * 7, []]
    out = whitening.whitened(table(spark, good + bad).repartition(7)).collect()
    n, deviation, white, explained = plain(good)
    assert len(out) == len(good) * 32 and {r["n"] for r in out} == {n}
    sign = {}
    for r in out:
        i, k = r["vec_id"], r["component"] - 1
        assert r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(white[i, k]), rel=1e-6, abs=1e-9)
        if abs(white[i, k]) > 1e-3:
            assert sign.setdefault(k, r["whitened"] * white[i, k] > 0) == (r["whitened"] * white[i, k] > 0)
    error = {r["identity_error"] for r in out}
    assert len(error) == 1 and max(error) < 1e-9


def test_repeated_rows_and_few_dimensions(spark):
    good = rows(np.random.default_rng(2), 50, 3)
    both = table(spark, good).unionByName(table(spark, good))
    out = whitening.whitened(both, components=2).collect()
    n, deviation, white, explained = plain(good + good)
    assert len(out) == 200 and out[0]["n"] == n == 100
    assert sorted(r["deviation"] for r in out if r["component"] == 1) == sorted(deviation)
    assert {r["component"] for r in out} == {1, 2}


def test_directions_without_spread(spark):
    rng = np.random.default_rng(3)
    flat = [[float(a), 2.0, float(a)] for a in rng.normal(size=30)]
    out = whitening.whitened(table(spark, flat)).collect()
    first = [r for r in out if r["component"] == 1]
    assert all(r["whitened"] is not None for r in first) and first[0]["explained"] == pytest.approx(1)
    assert all(r["whitened"] is None for r in out if r["component"] == 3)
    assert out[0]["identity_error"] < 1e-9
    same = whitening.whitened(table(spark, [[1.0, 2.0]] * 4)).collect()
    assert len(same) == 8 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 for r in same)


def test_empty(spark):
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [None, []])).collect() == []
    assert whitening.whitened(table(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_components_stay_exact(spark):
    """Squares beyond 64 bits, and components beyond what a long can hold."""
    rng = np.random.default_rng(4)
    big = [[float(c) for c in r] for r in rng.normal(size=(40, 4)) * [1e9, 1e4, 1, 1e12]]
    out = [r for r in whitening.whitened(table(spark, big)).collect() if r["component"] == 1]
    _, deviation, _, explained = plain(big)
    assert all(r["deviation"] == (deviation[r["vec_id"]] if deviation[r["vec_id"]] < 1 << 63 else None) for r in out)
    assert out[0]["explained"] == pytest.approx(explained[0], rel=1e-9)
    assert whitening.whitened(table(spark, [[1e300, 1.0], [-1e300, 2.0]])).count() == 4


def test_squares_by_limbs():
    rng = np.random.default_rng(5)
    for bits in (10, 40, 47, 60):
        t = rng.integers(-(1 << bits), 1 << bits, (300, 3))
        assert whitening.squares(t) == [sum(int(v) ** 2 for v in t[:, i]) for i in range(3)]


def test_cross_sums_by_polarisation(spark):
    x = np.random.default_rng(6).integers(-500, 500, (64, 5))
    known = spark.createDataFrame([(i, [int(c) for c in r]) for i, r in enumerate(x)], "id long, x array<long>").repartition(3)
    sums = [int(c) for c in x.sum(axis=0)]
    y = 64 * x - np.array(sums)
    assert whitening.cross_sums(known, 64, sums) == (y.T @ y).tolist()
