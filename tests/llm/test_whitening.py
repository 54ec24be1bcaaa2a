from fractions import Fraction
from math import floor

import numpy as np
import pytest

from attain.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component int, id string, i int, d int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, 1, 2, "x", 3, 4) for i, v in rows], SCHEMA)


def by_hand(rows, dim):
    """(kept rows, integers, eigenvalues, unit vectors, trace) with exact covariances."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    x = [[floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n = len(x)
    sums = [sum(r[k] for r in x) for k in range(dim)]
    cov = np.array([[float(sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in x) / n)
                     for j in range(dim)] for i in range(dim)])
    values, vectors = np.linalg.eigh(cov)
    return kept, x, sums, values[::-1], vectors[:, ::-1], np.trace(cov)


def check(found, rows, dim, components=8):
    kept, x, sums, values, vectors, trace = by_hand(rows, dim)
    n = len(x)
    rank = int((values > max(values[0], 0) * 1e-12).sum()) if n else 0
    k = min(components, rank)
    assert len(found) == len(kept) * k
    groups = {}
    for r in found:
        groups.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    signs = {}
    for (i, _), row in zip(kept, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        own = groups[i, deviation if deviation < 1 << 63 else None]
        assert sorted(own) == list(range(1, k + 1))
        for c, r in own.items():
            wanted = sum((a - s / n) * u for a, s, u in zip(row, sums, vectors[:, c - 1])) / values[c - 1] ** 0.5
            if abs(wanted) > 1e-6:
                signs.setdefault(c, np.sign(wanted * r["whitened"]))
            assert r["n"] == n and r["whitened"] * signs.get(c, 1) == pytest.approx(wanted, abs=1e-8)
            assert r["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-9) and r["identity_error"] < 1e-8


def test_against_exact_covariances(spark):
    rng = np.random.default_rng(1)
    scale = np.array([9, 5, 3, 2, 1, 0.5, 0.3, 0.2, 0.1, 0.05])
    rows = [(k, (rng.normal(size=10) * scale @ np.linalg.qr(np.ones((10, 10)) + np.diag(np.arange(10)))[0] + 7).tolist()) for k in range(60)]
    rows += [rows[3], (100, None), (101, []), (102, [None] + [1.0] * 9), (103, [float("nan")] * 10), (104, [float("inf")] + [0.0] * 9),
             (105, [1.0, 2.0]), (None, rows[5][1])]
    for parts in (1, 7):
        check(whitening.whiten(table(spark, rows).repartition(parts)).collect(), rows, 10)
    two = whitening.whiten(table(spark, rows), components=2)
    assert two.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(two.collect(), rows, 10, 2)


def test_little_variance_far_from_zero(spark):
    """Centring happens before the products: a mean 1e9 times the spread costs nothing."""
    rng = np.random.default_rng(2)
    rows = [(k, [float(2.0 ** 20 + v) for v in rng.integers(0, 8, 3)]) for k in range(40)]
    check(whitening.whiten(table(spark, rows)).collect(), rows, 3)


def test_few_equal_and_no_vectors(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [None])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []  # one vector varies in nothing
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).collect() == []
    rows = [(1, [1.0, 2.0, 5.0]), (2, [2.0, 2.0, 5.0]), (3, [4.0, 2.0, 5.0])]
    check(whitening.whiten(table(spark, rows)).collect(), rows, 3)  # one component


def test_huge_entries(spark):
    rows = [(1, [3.0e38, 1.0]), (2, [-3.0e38, 2.0]), (3, [0.0, 3.0])]
    found = whitening.whiten(table(spark, rows)).collect()
    assert len(found) == 6 and all(np.isfinite(r["whitened"]) for r in found)
    assert {r["vec_id"]: r["deviation"] for r in found}[1] is None  # beyond a long


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (7, 7), (40, 40), (40, 12)):
        m = rng.normal(size=(d, rank)) * np.logspace(0, -6, rank)
        a = m @ m.T
        factor = whitening.pivoted_cholesky(a)
        assert np.abs(factor @ factor.T - a).max() < 1e-13 * np.abs(a).max()
        pivots = []  # in pivot order the factor is lower triangular
        for c in range(factor.shape[1]):
            rest = [i for i in range(d) if i not in pivots]
            pivots.append(max(rest, key=lambda i: abs(factor[i, c]) if not factor[i, c + 1:].any() else -1))
            assert not factor[pivots[-1], c + 1:].any()
        values, vectors = whitening.one_sided_jacobi(factor)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        assert (np.diff(values) <= 0).all()
        assert np.abs(vectors * values @ vectors.T - a).max() < 1e-13 * np.abs(a).max()
        assert values[:3] == pytest.approx(np.linalg.eigvalsh(a)[::-1][:3], rel=1e-10)


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for high in (100, 1 << 24, 1 << 40, 1 << 53):
        y = rng.integers(-high, high, (300, 4))
        assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()


def test_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    dim = max(len(v) for _, v in rows if v)
    found = queries.op13_whitening(spark, folder).collect()
    kept = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    x = np.stack([np.floor(1024 * v) for _, v in kept])
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    white = centred @ vectors / np.sqrt(values)
    order = {i: k for k, (i, _) in enumerate(kept)}
    assert len(found) == 8 * len(kept)
    got = np.zeros_like(white)
    for r in found:
        got[order[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-6
    assert found[0]["identity_error"] < 1e-9
