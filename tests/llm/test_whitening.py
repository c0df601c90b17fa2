from __future__ import annotations

import math

import numpy as np
import pytest

from corpusmill.llm import queries, whitening


def whole(vectors):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]


class Dense:
    def __init__(self, a):
        self.a = a

    def __matmul__(self, block):
        return self.a @ block


@pytest.mark.parametrize(("size", "wanted"), [(200, 32), (40, 8), (5, 32), (1, 1), (64, 32)])
def test_pairs_equal_a_dense_decomposition(size, wanted):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    spread = np.linspace(1, 3, size) ** 4
    a = (q * spread) @ q.T
    values, vectors = whitening.jacobi_davidson(Dense((a + a.T) / 2), size, wanted)
    want = np.sort(spread)[::-1][:wanted]
    assert values == pytest.approx(want, rel=1e-12)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert vectors.T @ vectors == pytest.approx(np.eye(len(values)), abs=1e-12)


@pytest.mark.parametrize("spread", [[5.0] * 10 + [1.0] * 50, [3.0] + [0.0] * 59, [1.0] * 60, [1e6, 1e3] + [1.0] * 58])
def test_repeated_and_vanishing_eigenvalues(spread):
    size = len(spread)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((size, size)))[0]
    a = (q * spread) @ q.T
    values, vectors = whitening.jacobi_davidson(Dense((a + a.T) / 2), size, 12)
    assert values == pytest.approx(spread[:12], rel=1e-10, abs=1e-12 * spread[0])
    assert vectors.T @ vectors == pytest.approx(np.eye(12), abs=1e-12)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 3))
    assert whitening.minres(lambda v: a @ v, b, 200, 1e-14) == pytest.approx(np.linalg.solve(a, b), rel=1e-6, abs=1e-6)
    assert not whitening.minres(lambda v: a @ v, np.zeros((30, 2)), 5, 0.1).any()


def test_query_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(7)
    mixed = rng.standard_normal((150, 12)) @ rng.standard_normal((12, 40))
    vectors = mixed.astype(np.float32).astype(float).tolist()
    rows = [(i if i != 3 else 4, v) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [None] * 40), (902, [math.nan] * 40), (903, [math.inf] * 40), (904, []), (905, [1.0]), (None, vectors[5])]
    spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op11_whitening(spark, str(tmp_path))
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                  "explained": "double", "identity_error": "double"}
    x = whole(vectors + [vectors[5]])
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    c = np.array([[float(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    values, q = np.linalg.eigh(c.T @ c / n)
    values, q = values[::-1][:32], q[:, ::-1][:, :32]
    trace = np.trace(c.T @ c / n)
    ids = [i for i, _ in rows] + [None]
    want = {}
    for i, r, row in zip(ids, x, (c @ q) / np.sqrt(values), strict=True):
        want.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)), row))
    got = {}
    for r in found.collect():
        got.setdefault((r["vec_id"], r["deviation"]), {})
        got[r["vec_id"], r["deviation"]][r["component"]] = r
    assert len(got) == n
    sign = None
    for i, those in want.items():
        for deviation, row in those:
            mine = got[i, deviation]
            assert sorted(mine) == list(range(1, 33))
            w = np.array([mine[k]["whitened"] for k in range(1, 33)])
            if sign is None:
                sign = np.sign(w * row)
            assert w * sign == pytest.approx(row, abs=1e-7)  # both are as far off as rounding over the gaps
            assert mine[1]["explained"] == pytest.approx(values[0] / trace, rel=1e-9)
            assert mine[1]["n"] == n and 0 <= mine[1]["identity_error"] < 1e-8


def test_directions_of_no_variance_are_no_components(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    found, model, error = whitening.whiten(spark.createDataFrame(rows, "id long, v array<double>"), "v")
    assert len(model.values) == 1 and error < 1e-9
    w = np.array([r["whitened"][0] for r in found.collect()])
    assert w.mean() == pytest.approx(0, abs=1e-12) and w.var() == pytest.approx(1)


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", "b", 3), (1, [1.0, 2.0], "a", "b", 3), (2, [1e300, 1.0], "a", "b", 3)],
                               "id long, v array<double>, cm_x string, Whitened string, deviation int")
    found, model, error = whitening.whiten(df, "v")
    assert [(r["id"], r["cm_x"], r["deviation"], r["whitened"]) for r in found.collect()] == [(1, "a", 0, [])] * 2
    assert model.n == 2 and error == 0 and not len(model.values)
    found, model, _ = whitening.whiten(df.where("id < 0"), "v")
    assert found.count() == 0 and model.n == 0


def test_large_deviations_are_exact():
    x = np.array([[1 << 40, 0], [-(1 << 40), 3]])
    sums = [0, 3]
    want = [sum((10 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x.tolist()]
    assert whitening.exact_deviations(x, 10, sums) == [v if v < 1 << 63 else None for v in want]
    small = np.array([[5, 7], [9, -4]])
    assert whitening.exact_deviations(small, 3, [14, 3]) == [sum((3 * a - s) ** 2 for a, s in zip(r, [14, 3], strict=True)) for r in small.tolist()]
