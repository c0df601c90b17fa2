"""Forests over rows that are mostly 0: the same trees as over whole rows, from a small part of the values."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusmill.operators import forests

SIZE = 300


@pytest.fixture(scope="module")
def texts(spark):
    random.seed(3)
    rows = []
    for i in range(400):
        places = sorted(random.sample(range(SIZE), random.randint(0, 8)))
        values = [random.choice([-1.5, 0.0, 0.25, random.random()]) for _ in places]
        vector = Vectors.sparse(SIZE, places, values) if i % 5 else Vectors.dense(Vectors.sparse(SIZE, places, values).toArray())
        rows.append((i, (len(places) + random.randint(0, 2)) // 4, vector))
    return spark.createDataFrame(rows, ["unique_id", "label", "features"]).withColumn("label", F.col("label").cast("int")).repartition(3, "unique_id").cache()


def _trees(forest):
    below = sorted((r["tree"], r["start"], *[bytes(r[c]) for c in ("feature", "cut", "left", "counts")]) for r in forest.table.collect())
    return below, [a.tolist() for a in forest.top]


@pytest.mark.parametrize(("rows", "trees"), [(1 << 19, 1), (1 << 19, 6), (60, 6)])
def test_sparse_rows_give_the_same_forest(texts, monkeypatch, rows, trees):
    monkeypatch.setattr(forests, "ROWS", rows)
    found = []
    for sparse in (10**9, 8):
        monkeypatch.setattr(forests, "SPARSE", sparse)
        data = forests.prepare(texts)
        assert (data.kept is None) == (sparse > 8)
        forest = forests.grow(data, trees, depth=12)
        scores = sorted((r["unique_id"], r["prediction"], round(r["score"], 9)) for r in forest.predict(texts).collect())
        found.append((_trees(forest), scores, forest.accuracies(texts, range(1, trees + 1))))
    assert found[0] == found[1]


def test_slices_of_values_do_not_change_the_forest(texts, monkeypatch):
    data = forests.prepare(texts)
    whole = _trees(forests.grow(data, 4))
    monkeypatch.setattr(forests, "ENTRIES", 500)
    assert _trees(forests.grow(data, 4)) == whole


def test_a_task_takes_rows_by_the_values_that_they_keep(texts, monkeypatch):
    data = forests.prepare(texts)
    sizes = data.rows.agg(F.sum(F.length("bins")), F.max(F.length("bins"))).first()
    assert data.kept <= 8 * 400 and sizes[0] <= 3 * data.kept and sizes[1] <= 24  # before, 300 bytes a row
    monkeypatch.setattr(forests, "CELLS", 400 * SIZE // 4)  # before, each row was then sent once for each tree that drew it
    assert len(forests.grow(data, 3).top.tree) == 3
