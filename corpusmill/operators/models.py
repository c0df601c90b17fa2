"""Clustering, classification, tuning and baselines on ``pyspark.ml``.

Inputs are DataFrames with an ML vector column. Fits are distributed; the driver loops only over a
parameter grid and holds one score per parameter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import forests, metrics
from corpusmill.operators.aggregates import argmax_param, mode_by_group, mode_value, union_all
from corpusmill.operators.clusters import Clusters, fit_grid
from corpusmill.operators.forests import Forest
from corpusmill.operators.joins import lookup_map, nearest_to_center
from corpusmill.operators.sampling import stratified_kfold
from corpusmill.sources.staging import stage

RESULT_SCHEMA = "param int, metric string, value double"

# Trees stop at this depth; it stands for "unlimited".
UNLIMITED_DEPTH = 30


@contextmanager
def cached(*frames: DataFrame):
    """Keep inputs of an iterative fit for the length of a block; lost blocks are recomputed."""
    for f in frames:
        f.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for f in frames:
            f.unpersist()


def results_table(df: DataFrame, rows: Iterable[tuple]) -> DataFrame:
    """(param, metric, value) of a tuning run."""
    rows = [(int(p), str(m), float(v)) for p, m, v in rows]
    return df.sparkSession.createDataFrame(rows, RESULT_SCHEMA).coalesce(1)


def _grid(values: Iterable, fit: Callable, parallelism: int) -> list:
    """Results in the order of ``values``, several fits at once so that small stages overlap."""
    values = list(values)
    with ThreadPool(max(1, min(parallelism, len(values)))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.getActiveSession())(fit), values)


def _accuracy(df: DataFrame) -> float:
    return metrics.accuracy(df).first()["accuracy"]


# --- k-means ---------------------------------------------------------------------------------


def kmeans_fit(
    df: DataFrame, k: int, features: str = "features", seed: int = 42, n_init: int = 1, max_iter: int = 300
) -> Clusters:
    """k-means; of ``n_init`` starts, which share every scan, the one with the lowest cost is kept."""
    return fit_grid(df, [k], n_init, features, seed, max_iter)[k]


def map_majority(fit_on: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """(cluster, prediction): most frequent label of each cluster, smallest on a tie."""
    return mode_by_group(fit_on, cluster, label).withColumnRenamed(label, "prediction")


def map_nearest(
    train: DataFrame, centers: Sequence, id_col: str = "unique_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(cluster, prediction): label of the training row nearest to each center."""
    nearest = nearest_to_center(train, centers, id_col, vector).select("cluster", id_col)
    labels = train.select(id_col, F.col(label).alias("prediction"))
    return labels.join(F.broadcast(nearest), id_col).select("cluster", "prediction")


def cluster_label_identity(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """The cluster number taken as the label; meaningful for two clusters only."""
    return df.withColumn("prediction", F.col(cluster).cast("int"))


def cluster_label_majority(df: DataFrame, train: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Predict the majority training label of each cluster."""
    return lookup_map(df, map_majority(train, cluster, label), cluster)


def cluster_label_majority_eval(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Predict the majority label of the evaluated rows themselves. Leaks labels: not a default."""
    return lookup_map(df, map_majority(df, cluster, label), cluster)


def cluster_label_nearest(
    df: DataFrame, train: DataFrame, centers: Sequence, cluster: str = "cluster", id_col: str = "unique_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Predict the label of the training row nearest to the cluster's center."""
    return lookup_map(df, map_nearest(train, centers, id_col, vector, label), cluster)


def kmeans_predict(
    model: Clusters, train: DataFrame, df: DataFrame, mapping: str = "majority", features: str = "features"
) -> DataFrame:
    """Clusters of ``df`` turned into labels by one of the modes
    ``majority``, ``majority_eval``, ``nearest`` and ``identity``."""
    out = model.transform(df)
    if mapping == "identity":
        return cluster_label_identity(out)
    if mapping == "majority":
        return cluster_label_majority(out, model.transform(train))
    if mapping == "majority_eval":
        return cluster_label_majority_eval(out)
    if mapping == "nearest":
        as_array = train.withColumn("_v", vector_to_array(features))
        centers = [list(c) for c in model.clusterCenters()]
        return cluster_label_nearest(out, as_array, centers, vector="_v")
    raise ValueError(f"unknown mapping {mapping}")


def kmeans_tune_holdout(
    train: DataFrame, val: DataFrame, ks: Iterable[int] = range(2, 11), mapping: str = "majority",
    features: str = "features", seed: int = 42, n_init: int = 1, parallelism: int = 4,
) -> DataFrame:
    """(k, accuracy on the validation part) per k."""
    with cached(train, val):
        fitted = fit_grid(train, ks, n_init, features, seed)
        rows = _grid(
            fitted, lambda k: (k, "accuracy", _accuracy(kmeans_predict(fitted[k], train, val, mapping, features))), parallelism
        )
    return results_table(train, rows)


def kmeans_elbow(
    df: DataFrame, ks: Iterable[int] = range(2, 11), features: str = "features", seed: int = 42, n_init: int = 1
) -> DataFrame:
    """(k, sum of squared distances to the centers) per k, each of the best of ``n_init`` starts."""
    fitted = fit_grid(df, ks, n_init, features, seed)
    return results_table(df, [(k, "cost", m.trainingCost) for k, m in fitted.items()])


def kmeans_silhouette(
    df: DataFrame, ks: Iterable[int] = range(2, 11), features: str = "features", seed: int = 42, parallelism: int = 4, n_init: int = 1
) -> DataFrame:
    """(k, mean silhouette with squared Euclidean distance) per k, each of the best of ``n_init`` starts."""
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol="cluster")
    with cached(df):
        fitted = fit_grid(df, ks, n_init, features, seed)
        rows = _grid(fitted, lambda k: (k, "silhouette", evaluator.evaluate(fitted[k].transform(df))), parallelism)
    return results_table(df, rows)


# --- random forest ---------------------------------------------------------------------------


def rf_predict(model: RandomForestClassificationModel, df: DataFrame) -> DataFrame:
    """Predictions as integers, and the probability of class 1 as ``score``."""
    out = model.transform(df)
    return out.withColumns({
        "prediction": F.col("prediction").cast("int"), "score": vector_to_array("probability")[1]
    }).drop("rawPrediction", "probability")


def rf_grow(train: DataFrame, trees: int = 100, features: str = "features", **options) -> Forest:
    """A forest whose first trees can be scored on their own."""
    return forests.grow(forests.prepare(train, features), trees, **options)


def rf_fit_predict(train: DataFrame, df: DataFrame, **options) -> DataFrame:
    return rf_grow(train, **options).predict(df)


def rf_tune_holdout(
    train: DataFrame, val: DataFrame, trees: Iterable[int] = range(100, 1001, 100), forest: Forest | None = None, **options
) -> DataFrame:
    """(number of trees, accuracy on the validation part) per grid value, all from one ``forest`` of the largest size."""
    trees = list(trees)
    forest = forest or rf_grow(train, max(trees), **options)
    return results_table(train, [(t, "accuracy", score) for t, score in forest.accuracies(val, trees)])


class Tuned(NamedTuple):
    """Grid values with their mean accuracy over the folds, and the forest of the best of them over all rows."""

    grid: list[dict]
    best: Forest


def rf_tune_cv(
    train: DataFrame, trees: Sequence[int] = (20, 50), depths: Sequence[int | None] = (None, 5, 10),
    min_split: int = 10, folds: int = 3, id_col: str = "unique_id", features: str = "features", seed: int = 42,
    parallelism: int = 4,
) -> Tuned:
    """Exhaustive grid with stratified folds, scored by accuracy and refitted on all of ``train``.

    All numbers of trees of a fold and depth are prefixes of one forest.
    """
    depths = [UNLIMITED_DEPTH if d is None else d for d in depths]
    options = {"min_rows": max(1, min_split // 2), "seed": seed}
    folded = stage(stratified_kfold(train, id_col, "label", folds, seed), "folded")
    data = _grid(range(folds), lambda f: forests.prepare(folded.where(F.col("fold") != f), features), parallelism)

    def scores(job: tuple[int, int]) -> list[tuple[int, float]]:
        fold, depth = job
        forest = forests.grow(data[fold], max(trees), depth, **options)
        return forest.accuracies(folded.where(F.col("fold") == fold), trees)

    jobs = [(fold, depth) for depth in depths for fold in range(folds)]
    found = {(job, t): score for job, of_job in zip(jobs, _grid(jobs, scores, parallelism), strict=True) for t, score in of_job}
    grid = [
        {"numTrees": t, "maxDepth": depth, "accuracy": sum(found[(fold, depth), t] for fold in range(folds)) / folds}
        for t in trees for depth in depths
    ]
    best = max(grid, key=lambda r: r["accuracy"])
    return Tuned(grid, rf_grow(folded, best["numTrees"], features, depth=best["maxDepth"], **options))


def cv_results(model: Tuned) -> list[dict]:
    """Grid values with their mean accuracy."""
    return model.grid


def cv_stratified(
    df: DataFrame, folds: int = 10, id_col: str = "unique_id", label: str = "label", seed: int = 42,
    parallelism: int = 4, **options
) -> DataFrame:
    """Out-of-fold predictions of a random forest: (id, fold, label, prediction, score)."""
    folded = stratified_kfold(df, id_col, label, folds, seed)

    def out_of_fold(f: int) -> DataFrame:
        part = rf_fit_predict(folded.where(F.col("fold") != f), folded.where(F.col("fold") == f), seed=seed, **options)
        return part.select(id_col, "fold", label, "prediction", "score")

    folded = stage(folded.select(id_col, label, "fold", options.get("features", "features")), "folded")
    return stage(union_all(*_grid(range(folds), out_of_fold, parallelism)), "out-of-fold")


def fold_scores(predictions: DataFrame) -> DataFrame:
    """(fold, score): accuracy per fold."""
    equal = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.groupBy("fold").agg(F.avg(equal).alias("score"))


# --- baseline and search ---------------------------------------------------------------------


def baseline_majority(train: DataFrame, df: DataFrame, label: str = "label") -> DataFrame:
    """Predict the most common training label for every row."""
    common = mode_value(train, label).first()[label]
    return df.withColumn("prediction", F.lit(common).cast("int"))


def best_param(results: DataFrame) -> int:
    """Parameter with the best score."""
    return argmax_param(results).first()["param"]


def with_test_row(results: DataFrame, test_accuracy: float) -> DataFrame:
    """The tuning table plus a last row with the best parameter's score on the test part."""
    row = (best_param(results), "test accuracy", float(test_accuracy))
    return results.unionByName(results.sparkSession.createDataFrame([row], RESULT_SCHEMA))


def tune_and_test(
    train: DataFrame, val: DataFrame, test: DataFrame, tune: Callable[[DataFrame, DataFrame], DataFrame],
    predict: Callable[[int, DataFrame, DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Tune on the validation part, refit the best parameter on train only, predict the test part."""
    results = tune(train, val)
    predictions = predict(best_param(results), train, test)
    return with_test_row(results, _accuracy(predictions)), predictions
