"""Features, models and metrics on small tables with hand-made answers, and invariants."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import aggregates as ag
from corpusmill.operators import charts, clusters, joins, metrics, models
from corpusmill.operators import features as ft
from corpusmill.plans import classify
from corpusmill.sources import stores


# --- TF-IDF ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, "cat dog"), (2, "cat cat"), (3, "dog bird")]
    return spark.createDataFrame(rows, "unique_id long, t string").select("unique_id", F.split("t", " ").alias("tokens"))


def test_tfidf_weights(spark, texts):
    model = ft.tfidf_fit(texts, min_df=0.0, max_n=1)
    got = {(r["unique_id"], r["term"]): round(r["weight"], 6) for r in model.transform_long(texts).collect()}
    assert got == {
        (1, "cat"): 0.707107, (1, "dog"): 0.707107, (2, "cat"): 1.0, (3, "dog"): 0.605349, (3, "bird"): 0.795961,
    }
    vectors = model.transform(texts).select("unique_id", vector_to_array("features").alias("f")).collect()
    dense = {r["unique_id"]: [round(x, 6) for x in r["f"]] for r in vectors}
    assert dense == {1: [0.0, 0.707107, 0.707107], 2: [0.0, 1.0, 0.0], 3: [0.795961, 0.0, 0.605349]}
    new = spark.createDataFrame([(9, ["cat", "fish"]), (8, ["fish"])], "unique_id long, tokens array<string>")
    assert [tuple(r) for r in model.transform_long(new).collect()] == [(9, "cat", 1.0)]


def test_tfidf_min_df(texts):
    terms = ft.tfidf_fit(texts, min_df=0.5, max_n=1).vocabulary
    assert {r["term"]: r["df"] for r in terms.collect()} == {"cat": 2, "dog": 2}


def test_level_by_level_vocabulary_is_complete(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [f"t{j}" for j in rng.integers(0, 12, 15)]) for i in range(60)]
    df = spark.createDataFrame(rows, "unique_id long, tokens array<string>")
    seen = {}
    for _, t in rows:
        grams = {" ".join(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
    want = {g: c for g, c in seen.items() if c >= 0.05 * len(rows)}
    vocabulary, n = ft.document_frequencies(df, "tokens", 0.05)
    assert n == 60 and {r["term"]: r["df"] for r in vocabulary.collect()} == want


# --- vectors ---------------------------------------------------------------------------------


def test_vector_mean(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vector array<double>")
    rows = [(1, "a b"), (2, "a a b"), (3, "a zz"), (4, "zz"), (5, "")]
    df = spark.createDataFrame(rows, "unique_id long, t string").select("unique_id", tx.split_words("t").alias("tokens"))
    got = {r[0]: [round(x, 6) for x in r[1]] for r in ag.vector_mean(df, "tokens", vectors, 2).collect()}
    assert got == {1: [0.5, 0.5], 2: [0.666667, 0.333333], 3: [1.0, 0.0], 4: [0.0, 0.0], 5: [0.0, 0.0]}


def test_word2vec_and_sentence_embedding(spark):
    rows = [(i, ["red", "green", "blue", f"rare{i}"]) for i in range(20)] + [(99, ["rare1"])]
    df = spark.createDataFrame(rows, "unique_id long, tokens array<string>")
    model = ft.word2vec_fit(df, size=8)
    assert {r["word"] for r in ft.word_vectors(model).collect()} == {"red", "green", "blue", "rare1"}
    means = {r["unique_id"]: r["embedding"] for r in ft.sentence_embedding(df, model).collect()}
    assert len(means) == 21 and all(len(m) == 8 for m in means.values())
    assert np.allclose(means[2], means[3])
    own = {r["word"]: r["vector"] for r in ft.word_vectors(model).collect()}
    assert np.allclose(means[99], own["rare1"])


def test_batch_embed(spark):
    from corpusmill.queries.models import hashing_encoder

    df = spark.createDataFrame([(i, f"word{i % 3} and more") for i in range(30)], "unique_id long, body string")
    got = {r["unique_id"]: r["embedding"] for r in ft.batch_embed(df, "body", hashing_encoder, 7).collect()}
    assert len(got) == 30 and got[0] == got[3] and got[0] != got[1]


def test_vector_size_is_checked(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "unique_id long, embedding array<float>")
    with pytest.raises(Exception, match="vector of size 1"):
        ft.vector_unwrap(df, size=2).collect()


def test_pca_is_centred_with_fixed_sign(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 4)) * [5, 2, 1, 0.5] + 10
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(data)], "unique_id long, embedding array<double>")
    out = ft.pca_2d(ft.vector_unwrap(df)).select("unique_id", "pc1", "pc2").orderBy("unique_id").toPandas()
    centred = data - data.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    for i, name in enumerate(("pc1", "pc2")):
        axis = axes[i] * np.sign(axes[i][np.abs(axes[i]).argmax()])
        assert np.allclose(out[name], centred @ axis, atol=1e-8)


def test_vector_store(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, [0.5, 1.5])], "unique_id long, label int, embedding array<float>")
    stores.save_vectors(df, str(tmp_path / "v"))
    assert [tuple(r) for r in stores.load_vectors(spark, str(tmp_path / "v")).collect()] == [(1, 0, [0.5, 1.5])]


# --- joins and label mapping -----------------------------------------------------------------


def test_features_need_labels(spark):
    f = spark.createDataFrame([(1, 0.5), (2, 0.7)], "unique_id long, x double")
    y = spark.createDataFrame([(1, 0), (3, 1)], "unique_id long, label int")
    with pytest.raises(Exception, match="key without partner"):
        joins.join_features_labels(f, y).collect()
    ok = joins.join_features_labels(f.where("unique_id = 1"), y.where("unique_id = 1"))
    assert [tuple(r) for r in ok.collect()] == [(1, 0.5, 0)]


def test_majority_mapping(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 1), (2, 1)]
    df = spark.createDataFrame(rows, "cluster int, label int")
    assert {r[0]: r[1] for r in models.map_majority(df).collect()} == {0: 0, 1: 0, 2: 1}
    assert ag.mode_value(df.where("cluster = 1"), "label").first()["label"] == 0


def test_nearest_mapping(spark):
    rows = [(1, 1, [1.0, 1.0]), (2, 0, [9.0, 9.0]), (3, 0, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "unique_id long, label int, embedding array<float>")
    centers = [[0.0, 0.0], [10.0, 10.0]]
    nearest = {r["cluster"]: (r["unique_id"], round(r["distance"], 6)) for r in joins.nearest_to_center(df, centers).collect()}
    assert nearest == {0: (1, 1.414214), 1: (2, 1.414214)}
    assert {r[0]: r[1] for r in models.map_nearest(df, centers).collect()} == {0: 1, 1: 0}


# --- models ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, [float(x) for x in rng.normal(size=3) + 6 * (i % 2)]) for i in range(200)]
    return ft.vector_unwrap(spark.createDataFrame(rows, "unique_id long, label int, embedding array<double>"))


def test_kmeans(blobs, tmp_path, spark):
    elbow = {r["param"]: r["value"] for r in models.kmeans_elbow(blobs, range(2, 5)).collect()}
    assert elbow[2] > elbow[3] > elbow[4] > 0
    silhouette = models.kmeans_silhouette(blobs, range(2, 5))
    assert models.best_param(silhouette) == 2
    fitted = models.kmeans_fit(blobs, 2, n_init=2)
    stores.save_model(fitted, str(tmp_path / "m"))
    again = stores.load_model(clusters.Clusters, str(tmp_path / "m")).transform(blobs).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in again) == [100, 100]
    scatter = charts.cluster_scatter(fitted.transform(blobs))
    assert scatter.where("is_center").count() == 2 and scatter.where("not is_center").count() == 200


@pytest.mark.parametrize("mapping", ["majority", "nearest", "majority_eval"])
def test_kmeans_holdout(blobs, mapping):
    parts = classify.embedding_parts(blobs.drop("features"))
    outcome = classify.kmeans_holdout(parts, range(2, 4), mapping)
    rows = outcome.results.collect()
    assert [r["param"] for r in rows] == [2, 3, 2] and rows[-1]["metric"] == "test accuracy"
    assert rows[-1]["value"] == 1.0


def test_forest_beats_baseline(blobs):
    parts = classify.embedding_parts(blobs.drop("features"), balance="train")
    outcome = classify.random_forest_holdout(parts, (5, 10))
    base = metrics.accuracy(classify.baseline(parts)).first()[0]
    assert outcome.results.collect()[-1]["value"] > base
    assert outcome.predictions.where("score < 0 or score > 1").count() == 0


def test_cross_validation(blobs):
    folds = models.cv_stratified(blobs, folds=4, trees=5)
    assert folds.count() == 200 and folds.select("unique_id").distinct().count() == 200
    scores = models.fold_scores(folds)
    assert scores.count() == 4 and ag.mean_scores(scores).first()[0] > 0.95
    fitted = models.rf_tune_cv(blobs, trees=(3, 5), depths=(None, 2))
    assert len(models.cv_results(fitted)) == 4


def test_text_runs(spark):
    rows = [(i, i % 2, ("alpha beta gamma " if i % 2 else "delta omega kappa ") + f"common word{i % 7}") for i in range(120)]
    df = spark.createDataFrame(rows, "unique_id long, label int, body string")
    tfidf = classify.tfidf_parts(df, "body", ["the"])
    assert classify.random_forest_holdout(tfidf, (5,)).results.collect()[-1]["value"] > 0.9
    triplets = classify.triplet_parts(df, "body", ["the"], (0.2, 0.2, 0.2))
    assert classify.kmeans_holdout(triplets, range(2, 3)).results.collect()[-1]["value"] > 0.9
    words = classify.word2vec_parts(df, "body", size=8)
    assert classify.random_forest_holdout(words, (5,)).results.count() == 2


# --- metrics ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_metrics(predictions):
    assert {r["label"]: (r["pred_0"], r["pred_1"]) for r in metrics.confusion_matrix(predictions).collect()} == {0: (2, 1), 1: (1, 2)}
    assert round(metrics.accuracy(predictions).first()[0], 6) == 0.666667
    assert [round(x, 6) for x in metrics.precision_recall(predictions).first()] == [0.666667, 0.666667]
    report = {r["class"]: r for r in metrics.classification_report(predictions).collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert all(round(r["f1"], 6) == 0.666667 for r in report.values())
    assert report["0"]["support"] == 3 and report["macro avg"]["support"] == 6


def test_all_zero_predictions(predictions):
    zero = predictions.withColumn("prediction", F.lit(0))
    assert metrics.accuracy(zero).first()[0] == 0.5
    assert tuple(metrics.precision_recall(zero).first()) == (0.0, 0.0)
    assert {r["label"]: (r["pred_0"], r["pred_1"]) for r in metrics.confusion_matrix(zero).collect()} == {0: (3, 0), 1: (3, 0)}


def test_roc(predictions):
    curve = sorted((round(r["fpr"], 6), round(r["tpr"], 6)) for r in metrics.roc_curve(predictions).collect())
    assert curve == [(0.0, 0.0), (0.0, 0.333333), (0.333333, 0.666667), (0.666667, 1.0), (1.0, 1.0)]
    assert round(metrics.roc_auc(predictions).first()[0], 6) == 0.777778


def test_auc_agrees_with_the_evaluator(spark):
    scored = spark.range(2000).select(
        (F.rand(1) > 0.6).cast("int").alias("label"), F.round(F.rand(2), 2).alias("score")
    ).withColumn("score", F.col("score") + F.col("label") * 0.2)
    scored = spark.createDataFrame(scored.collect(), scored.schema)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert metrics.roc_auc(scored, buckets=8).first()[0] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


def test_published_confusion_gives_published_metrics(spark):
    cells = [(0, 0, 124936), (0, 1, 13177), (1, 0, 16905), (1, 1, 121637)]
    df = spark.createDataFrame(cells, "label int, prediction int, n int")
    rows = df.select("label", "prediction", F.explode(F.sequence(F.lit(1), "n")))
    assert round(metrics.accuracy(rows).first()[0], 2) == 0.89


def test_embedding_queries_take_documents_without_a_label(spark, tmp_path):
    from corpusmill.queries import models as q

    docs = [(1, "red fish blue fish"), (2, "red house blue house"), (3, "onlyhere onlyhere onlyhere onlyhere onlyhere"), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d = str(tmp_path)
    assert {r["unique_id"] for r in q.batch_embed(spark, d).collect()} == {1, 2, 3, 4}
    assert {r["unique_id"] for r in q.sentence_embedding(spark, d).collect()} == {1, 2, 3, 4}
    assert "onlyhere" in {r["word"] for r in q.word2vec_fit(spark, d).collect()}


def test_silhouette_and_scatter_use_ten_starts(spark, monkeypatch):
    from corpusmill.operators import models as m
    from corpusmill.queries import models as q

    data = spark.createDataFrame([(i, i % 2, [float(i % 3), float(i)]) for i in range(12)], "unique_id long, label int, embedding array<double>")
    dense = ft.vector_unwrap(data).drop("embedding")
    starts, fit = [], m.fit_grid

    def counted(df, ks, n_init=1, *rest):
        starts.append((list(ks), n_init))
        return fit(df, ks, 1, *rest)

    monkeypatch.setattr(m, "fit_grid", counted)
    monkeypatch.setattr(q, "_dense", lambda spark, d: dense)
    q.kmeans_silhouette(spark, "")
    q.chart_cluster_scatter(spark, "")
    q.kmeans_elbow(spark, "")
    assert starts == [(list(range(2, 11)), 10), ([3], 10), (list(range(2, 11)), 10)]


def plain_lloyd(x, centers, max_iter):
    for _ in range(max_iter):
        near = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        after = np.array([x[near == i].mean(0) if (near == i).any() else centers[i] for i in range(len(centers))])
        if np.sqrt(((after - centers) ** 2).sum(1)).max() <= clusters.MOVED:
            break
        centers = after
    return centers, ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum()


@pytest.mark.parametrize(("direct", "width", "cells"), [(1 << 24, 1 << 22, 1 << 22), (0, 1, 7)])
def test_runs_of_a_grid_equal_single_fits(spark, monkeypatch, direct, width, cells):
    """Whichever way sums are added up, and however many scans the centers take."""
    for name, value in (("DIRECT", direct), ("WIDTH", width), ("CELLS", cells)):
        monkeypatch.setattr(clusters, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 4)) + 1000
    df = ft.vector_unwrap(spark.createDataFrame([(r.tolist(),) for r in x], "embedding array<double>")).repartition(4)
    firsts = [x[rng.choice(len(x), k, replace=False)] for k in (1, 2, 3, 5)]
    with clusters._points(df, "features") as points:
        points.shift = np.full(4, 1000.0)
        for limit in (0, 2, 100):
            found = clusters.lloyd(points, [f - 1000 for f in firsts], limit)
            for f, (centers, cost) in zip(firsts, found, strict=True):
                want, want_cost = plain_lloyd(x, f, limit)
                assert centers + 1000 == pytest.approx(want, abs=1e-9) and cost == pytest.approx(want_cost, rel=1e-6)


def test_grid_finds_the_blobs_and_takes_odd_tables(spark, blobs):
    found = clusters.fit_grid(blobs, [1, 2], n_init=3)
    assert sorted(found) == [1, 2] and found[1].trainingCost > 5 * found[2].trainingCost
    assert sorted(np.array(found[2].clusterCenters()).mean(1).round().tolist()) == [0, 6]
    same = ft.vector_unwrap(spark.createDataFrame([([1.0, 2.0],)] * 5, "embedding array<double>"))
    one = clusters.fit_grid(same, [3])[3]
    assert one.trainingCost == 0 and len(one.clusterCenters()) == 3
    assert one.transform(same).select("cluster").distinct().count() == 1
    assert clusters.fit_grid(same.limit(0), [2])[2].clusterCenters() == []


def test_prefixes_of_a_forest_are_forests(spark, blobs):
    """All trees vote as Spark's own forest does, and a prefix as the sum of its trees' own probabilities."""
    from pyspark.ml.classification import RandomForestClassificationModel

    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(2)), rng.normal(size=4).round(1).tolist()) for i in range(300)]
    df = ft.vector_unwrap(spark.createDataFrame(rows, "unique_id long, label int, embedding array<double>")).repartition(3)
    forest = models.rf_grow(df, 7, depth=6)
    assert isinstance(forest.model, RandomForestClassificationModel)
    spark_own = {r["unique_id"]: (r["prediction"], r["score"]) for r in models.rf_predict(forest.model, df).collect()}
    own = {r["unique_id"]: (r["prediction"], r["score"]) for r in forest.predict(df).collect()}
    assert {i: p for i, (p, _) in own.items()} == {i: p for i, (p, _) in spark_own.items()}
    assert all(own[i][1] == pytest.approx(spark_own[i][1]) for i in own)
    votes = {}
    for tree in forest.model.trees:
        for r in tree.transform(df).select("unique_id", vector_to_array("probability").alias("p")).collect():
            votes.setdefault(r["unique_id"], []).append(r["p"])
    for size in (1, 4, 7):
        want = {i: int(np.argmax(np.sum(v[:size], axis=0))) for i, v in votes.items()}
        assert {r["unique_id"]: r["prediction"] for r in forest.predict(df, size).collect()} == want
    right = [(s, np.mean([int(np.argmax(np.sum(votes[i][:s], axis=0))) == y for i, y, _ in rows])) for s in (4, 1, 7)]
    assert dict(forest.accuracies(df, [4, 1, 7])) == pytest.approx(dict(right))
    assert [r["value"] for r in models.rf_tune_holdout(df, df, [1, 4, 7], forest).orderBy("param").collect()] == pytest.approx([right[1][1], right[0][1], right[2][1]])
    with pytest.raises(ValueError):
        forest.accuracies(df, [8])
    assert forest.accuracies(df.limit(0), [3]) == [(3, 0.0)]


def test_roc_corners_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(2)), float(rng.integers(40))) for _ in range(300)] + [(1, 50.0 + i) for i in range(6)] + [(0, -1.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "label int, score double")
    steps = {}
    for y, x in rows:
        p, n = steps.get(x, (0, 0))
        steps[x] = (p + y, n + 1 - y)
    order = sorted(steps, reverse=True)
    kept = [i for i, x in enumerate(order) if i in (0, len(order) - 1) or steps[x] != steps[order[i + 1]]]
    total = np.cumsum([steps[x] for x in order], axis=0)
    want = sorted([(0.0, 0.0)] + [(total[i, 1] / total[-1, 1], total[i, 0] / total[-1, 0]) for i in kept])
    for buckets in (3, 7, None):
        found = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, buckets=buckets, corners=True).collect())
        assert np.array(found) == pytest.approx(np.array(want))
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(found, found[1:]))
        assert area == pytest.approx(metrics.roc_auc(df).first()["auc"])
    assert len(kept) < len(order)


def test_fold_reports(spark):
    rows = [(0, 1, 1), (0, 1, 0), (0, 0, 0), (1, 0, 1), (1, 1, 1)]
    found = {(r["fold"], r["class"]): r for r in classify.fold_reports(spark.createDataFrame(rows, "fold int, label int, prediction int")).collect()}
    assert set(found) == {(f, c) for f in (-1, 0, 1) for c in (0, 1)}
    assert (found[0, 1]["precision"], found[0, 1]["recall"], found[0, 1]["support"]) == (1.0, 0.5, 2.0)
    assert (found[1, 0]["precision"], found[1, 0]["recall"], found[1, 0]["f1"]) == (0.0, 0.0, 0.0)
    assert found[-1, 1]["precision"] == pytest.approx(0.75) and found[-1, 1]["recall"] == pytest.approx(0.75)
    assert found[0, 1]["false_negatives"] == 1 and found[1, 1]["false_positives"] == 1


def test_forest_grid_tells_the_grid_and_the_test_scores(blobs):
    parts = classify.embedding_parts(blobs.drop("features"))
    rows = classify.forest_grid(parts, (3, 5), (None, 2)).collect()
    assert len(rows) == 7 and {r["metric"] for r in rows} == {"accuracy", "test accuracy", "test precision", "test recall"}
    assert all(r["value"] == 1.0 for r in rows if r["metric"].startswith("test"))


@pytest.mark.parametrize("most", [1 << 19, 60])
def test_forest_nodes_are_those_of_brute_force(spark, monkeypatch, most):
    """Every tree's nodes count the rows it drew; no split is worse than none. ``most``: nodes with more rows are split by sums of tasks."""
    from corpusmill.operators import forests

    monkeypatch.setattr(forests, "ROWS", most)
    rng = np.random.default_rng(3)
    rows = [(i, i % 10 and int(x[0] > 0), x.tolist()) for i, x in enumerate(rng.normal(size=(300, 5)).round(1))]
    df = ft.vector_unwrap(spark.createDataFrame(rows, "unique_id long, label int, embedding array<double>")).repartition(3)
    data = forests.prepare(df)
    forest = forests.grow(data, 4, 5, min_rows=3)
    assert (len(forest.top.tree) > 4) == (most == 60)
    binned = data.rows.toArrow()
    x, y, ids = forests._matrix(binned, 5), binned.column("label").to_numpy(), binned.column("row").to_numpy()
    for tree, (feature, cut, left, counts) in forest._whole_trees():
        draws = forests._drawn(ids, tree, 42, False)
        at, level = {0: np.arange(300)}, {0: 0}
        for i in range(len(feature)):
            own = at[i]
            assert np.bincount(y[own], draws[own], 2).tolist() == counts[i].tolist()
            if feature[i] < 0:
                continue
            goes = x[own, feature[i]] > cut[i]
            for child, part in ((left[i], own[~goes]), (left[i] + 1, own[goes])):
                at[child], level[child] = part, level[i] + 1
                assert draws[part].sum() >= 3
            assert level[left[i]] <= 5
            gini = lambda c: c.sum() - (c**2.0).sum() / c.sum()
            assert gini(counts[left[i]]) + gini(counts[left[i] + 1]) < gini(counts[i])
    assert forest.accuracies(df, [4])[0][1] > 0.85


def test_forest_reads_sparse_and_dense_vectors_alike(spark):
    from pyspark.ml.linalg import Vectors

    from corpusmill.operators import forests

    dense = [[0.0, 2.0, -1.0], [0.0, 0.0, 0.0], [3.0, 0.0, 1.5]] * 20
    frames = [
        spark.createDataFrame([(i, i % 3 % 2, make(x)) for i, x in enumerate(dense)], ["unique_id", "label", "features"]).coalesce(1)
        for make in (Vectors.dense, lambda x: Vectors.sparse(3, [(j, v) for j, v in enumerate(x) if v]))
    ]
    found = [sorted(map(tuple, forests.prepare(df).rows.collect())) for df in frames]
    assert found[0] == found[1] and len(found[0]) == 60
    with pytest.raises(Exception, match="labels"):
        forests.prepare(frames[0].withColumn("label", F.lit(None).cast("int")))


def test_grid_values_of_cross_validation_are_forests_of_their_own_folds(blobs):
    """One forest for each fold and depth: the scores of a grid value are those of the prefix, and the best is refitted on all rows."""
    fitted = models.rf_tune_cv(blobs, trees=(5, 3), depths=(2,), folds=2)
    assert [(r["numTrees"], r["maxDepth"]) for r in models.cv_results(fitted)] == [(5, 2), (3, 2)]
    assert fitted.best.trees == max(models.cv_results(fitted), key=lambda r: r["accuracy"])["numTrees"]
    assert fitted.best.predict(blobs).where("label = prediction").count() > 180


def _both_kinds(spark, rows=60, size=12):
    """Rows of three groups as sparse vectors, as dense ones, and as one and the other in turn."""
    rng = np.random.default_rng(4)
    table = []
    for i in range(rows):
        places = size // 3 * (i % 3) + np.array([0, rng.integers(1, size // 3)])
        table.append(Vectors.sparse(size, places, [3.0 + rng.random(), rng.random()]))
    kinds = {"sparse": table, "dense": [Vectors.dense(x.toArray()) for x in table]}
    kinds["mixed"] = [kinds["dense" if i % 2 else "sparse"][i] for i in range(rows)]
    return {k: spark.createDataFrame([(i, x) for i, x in enumerate(xs)], ["i", "features"]).repartition(2, "i") for k, xs in kinds.items()}


def test_sparse_dense_and_mixed_vectors_give_the_same_clusters(spark):
    """Up to the numbers of the clusters, as the last digits of the cost choose among equal starts."""
    found, groups = {}, {}
    for kind, df in _both_kinds(spark).items():
        found[kind] = clusters.fit_grid(df, [3], n_init=5)[3]
        rows = found[kind].transform(df).collect()
        groups[kind] = {frozenset(r["i"] for r in rows if r["cluster"] == c) for c in range(3)}
    for kind in found:
        assert groups[kind] == {frozenset(range(g, 60, 3)) for g in range(3)}
        centers, want = (np.array(sorted(found[k].clusterCenters(), key=np.argmax)) for k in (kind, "dense"))
        assert np.allclose(centers, want) and found[kind].trainingCost == pytest.approx(found["dense"].trainingCost)


def test_scans_of_sparse_vectors_read_their_entries_only(spark):
    df = spark.createDataFrame([(Vectors.sparse(50_000, [i, i + 7, 40_000], [1.0, 2.0, 3.0]),) for i in range(100)], ["features"])

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    with clusters._points(df, "features") as points:
        total = sum(r["n"] for r in points.rows.mapInArrow(sizes, "n long").collect())
        assert points.size == 50_000 and total < 100 * 1000  # 400,000 bytes a row as dense arrays


def test_a_vector_of_another_size_fails(spark):
    for other in (Vectors.sparse(4, [0], [1.0]), Vectors.dense([1.0, 2.0])):
        df = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (other,)], ["features"]).coalesce(1)
        with pytest.raises(Exception, match="not of size 3"):
            clusters.fit_grid(df, [2])
