from __future__ import annotations

import math
import random

import numpy as np
import pytest

from corpusmill.llm import pivots


def brute(rows, k, step):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in whole:
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("n", "size", "blocks"), [(300, 8, (3, 17)), (40, 2, (256, 2048)), (6, 3, (2, 2))])
def test_equals_brute_force(spark, n, size, blocks):
    rng = random.Random(n)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.5, 0.0]) for _ in range(size)]) for i in range(n)]
    vectors = pivots.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found = pivots.top_k(vectors, vectors.where("vec_id % 5 = 0"), 10, 4, *blocks).collect()
    assert {tuple(r) for r in found} == brute(rows, 10, 5) and len(found) == len(brute(rows, 10, 5))


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (None, [1.0, 1.0]),
            (5, [1.0]), (6, [3.0, -1.0]), (7, [3.0, -1.0]), (8, []), (9, [1e6, 1e6])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    vectors = pivots.integer_vectors(df, "vec_id", "embedding")
    found = {tuple(r) for r in pivots.top_k(vectors, vectors, 2).collect()}
    assert found == {r for r in brute(rows, 2, 1)}
    empty = vectors.where("vec_id < 0")
    assert pivots.top_k(empty, empty).count() == 0 and pivots.top_k(vectors, empty).count() == 0


def test_repeated_queries_have_all_their_answers(spark):
    rng = random.Random(5)
    rows = [(0 if i < 40 else i, [float(rng.randrange(9)) for _ in range(3)]) for i in range(120)]
    vectors = pivots.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = pivots.top_k(vectors, vectors.where("vec_id % 20 = 0"), 10, 4, 7, 11).collect()
    others = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q, a in others:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in others if i != q)[:10]
            want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in found) == sorted(want) and len(want) == 10 * 44


def test_bounds_hold_and_leave_candidates_out():
    rng = np.random.default_rng(1)
    centers = rng.integers(-900, 900, (6, 12))
    x = np.concatenate([c + rng.integers(-20, 20, (50, 12)) for c in centers])
    points = x[::60]
    table = pivots._distances(x, points)
    bound = pivots.upper_bounds(x, table, x, table)
    true = x @ x.T
    assert (bound >= true).all()
    assert np.median(bound - true) < 0.2 * np.abs(true).mean()
