from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from corpusmill.operators import clusters, components
from corpusmill.operators import features as ft


def dense_answer(data, k=2):
    centred = data - data.mean(axis=0)
    _, lengths, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:k] * np.sign(axes[np.arange(k), np.abs(axes[:k]).argmax(axis=1)])[:, None]
    return centred @ axes.T, lengths[:k] ** 2 / len(data)


def vectors(spark, data, kind):
    def made(i, row):
        if kind == "dense" or (kind == "mixed" and i % 3):
            return Vectors.dense(row)
        at = np.flatnonzero(row)
        return Vectors.sparse(len(row), at, row[at])

    return spark.createDataFrame([(i, made(i, row)) for i, row in enumerate(data)], ["id", "features"]).repartition(5)


def found(df, k=2):
    model = components.fit_components(df, k)
    rows = model.transform(df).select("id", "components").orderBy("id").collect()
    return np.array([r["components"] for r in rows]), model


@pytest.mark.parametrize("kind", ["dense", "sparse", "mixed"])
@pytest.mark.parametrize("cells, direct, chunk", [(1 << 22, 1 << 24, 4096), (64, 0, 7)])
def test_components_equal_a_dense_decomposition(spark, monkeypatch, kind, cells, direct, chunk):
    monkeypatch.setattr(components, "CELLS", cells)
    monkeypatch.setattr(components, "DIRECT", direct)
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(150, 90)) * (rng.random((150, 90)) < 0.2) * np.linspace(3, 1, 90) + (rng.random(90) < 0.1) * 20
    data[5] = 0
    scores, model = found(vectors(spark, data, kind))
    plain, variances = dense_answer(data)
    assert np.allclose(scores, plain, atol=1e-6) and np.allclose(model.variances, variances, rtol=1e-9)


def test_close_variances_survive_cuts_of_the_subspace(spark):
    """Nothing stands out, and the space is far wider than the widest subspace."""
    rng = np.random.default_rng(8)
    data = rng.normal(size=(400, 300))
    scores, model = found(vectors(spark, data, "dense"))
    assert np.allclose(scores, dense_answer(data)[0], atol=1e-6)
    assert model.products > components.BLOCKS


def test_far_mean(spark):
    data = np.random.default_rng(2).normal(size=(100, 6)) * [4, 2, 1, 1, 1, 1] + 1e6
    assert np.allclose(found(vectors(spark, data, "dense"))[0], dense_answer(data)[0], atol=1e-6)


def test_few_dimensions_no_variance_and_odd_tables(spark):
    line = np.outer(np.arange(10.0), [3, 4, 0])
    scores, model = found(vectors(spark, line, "sparse"))
    assert np.allclose(scores[:, 0], (np.arange(10) - 4.5) * 5) and np.allclose(scores[:, 1], 0, atol=1e-9)
    assert np.allclose(found(vectors(spark, np.ones((4, 3)), "dense"))[0], 0)
    single, _ = found(vectors(spark, np.arange(4.0)[:, None], "dense"))
    assert np.allclose(single, np.column_stack([np.arange(4) - 1.5, np.zeros(4)]))
    df = vectors(spark, line, "dense")
    assert ft.pca_2d(df.where("id < 0")).count() == 0
    nulls = df.withColumn("features", F.when(F.col("id") != 3, F.col("features")))
    rows = {r["id"]: (r["pc1"], r["pc2"]) for r in ft.pca_2d(nulls).collect()}
    assert rows[3] == (None, None) and rows[2] is not None and len(rows) == 10
    apart = df.unionByName(vectors(spark, np.ones((1, 2)), "dense"))
    with pytest.raises(ValueError, match="vectors of 2 and of 3 entries"):
        components.fit_components(apart, 2)


def test_wide_sparse_rows(spark):
    """200,000 columns: a dense covariance would take 320 GB."""
    size, n = 200_000, 2_000
    base = spark.range(n, numPartitions=8)

    @F.udf(returnType=VectorUDT())
    def sparse(i):
        at = np.unique(np.random.default_rng(i).integers(100, size, 30))
        signal = [9.0 if i % 2 else -9.0, 5.0 if i % 3 else -10.0]
        return Vectors.sparse(size, [0, 1, *at.tolist()], signal + [0.1] * len(at))

    df = base.select("id", sparse("id").alias("features"))
    model = components.fit_components(df, 2)
    assert abs(model.loadings[0, 0]) > 0.999 and abs(model.loadings[1, 1]) > 0.999
    assert model.variances == pytest.approx([81, 50], rel=0.01)
    assert clusters.DIRECT < 8 * size * components.WIDTH * 8  # so Spark adds up the tasks' sums
