"""Features, tuning on a hold-out part, and evaluation on the test part."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import metrics, models
from corpusmill.operators.features import (
    sentence_embedding, tfidf_fit, triplet_vectors, vector_unwrap, word2vec_fit,
)
from corpusmill.operators.sampling import balance_undersample, split_and_balance
from corpusmill.plans.contrast import mine
from corpusmill.sources.staging import stage


class Parts(NamedTuple):
    train: DataFrame
    val: DataFrame
    test: DataFrame


class Outcome(NamedTuple):
    results: DataFrame  # (param, metric, value), last row from the test part
    predictions: DataFrame  # of the test part


def parts_of(df: DataFrame) -> Parts:
    return Parts(*[df.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")])


def tfidf_parts(
    df: DataFrame, text: str, stopwords: Sequence[str], min_df: float = 0.01, max_n: int = 3,
    balance: str = "train", seed: int = 42,
) -> Parts:
    """(unique_id, label, features) with a vocabulary fitted on the training part."""
    parts = split_and_balance(df, balance=balance, seed=seed)
    parts = parts.select("unique_id", "label", "split", tx.term_tokens(text, stopwords).alias("tokens"))
    parts = stage(parts, "split-tokens")
    model = tfidf_fit(parts.where(F.col("split") == "train"), "tokens", min_df, max_n)
    return parts_of(stage(model.transform(parts).drop("tokens"), "tfidf-features"))


def triplet_parts(
    df: DataFrame, text: str, stopwords: Sequence[str], supports: tuple[float, float, float],
    balance: str = "both", mine_on: str = "train", seed: int = 42,
) -> Parts:
    """(unique_id, label, features) with one 0/1 entry per frequent triplet.

    ``mine_on='all'`` mines every part and so leaks the test part into the choice of features.
    """
    parts = split_and_balance(df, balance=balance, seed=seed)
    items = tx.item_set(tx.normal_words(text), stopwords).alias("items")
    parts = stage(parts.select("unique_id", "label", "split", items), "split-baskets")
    source = parts if mine_on == "all" else parts.where(F.col("split") == "train")
    mined = mine(source.select("unique_id", "label", "items"), *supports)
    return parts_of(stage(triplet_vectors(parts, mined.triplets), "triplet-features"))


def word2vec_parts(
    df: DataFrame, text: str, size: int = 100, window: int = 5, min_count: int = 2,
    balance: str = "before", seed: int = 42, **fit_options,
) -> Parts:
    """(unique_id, label, features) with the mean of the word vectors of each text."""
    parts = split_and_balance(df, balance=balance, seed=seed)
    tokens = tx.split_words(text).alias("tokens")
    parts = stage(parts.select("unique_id", "label", "split", tokens), "split-words")
    model = word2vec_fit(parts, "tokens", size, window, min_count, seed=seed, **fit_options)
    means = vector_unwrap(sentence_embedding(parts, model), "embedding", size)
    features = parts.drop("tokens").join(means.select("unique_id", "features"), "unique_id")
    return parts_of(stage(features, "word2vec-features"))


def word2vec_features(df: DataFrame, text: str, size: int = 100, window: int = 5, min_count: int = 2, seed: int = 42) -> DataFrame:
    """(unique_id, label, features) of balanced classes: the mean of the word vectors of each text."""
    rows = balance_undersample(df, seed=seed).select("unique_id", "label", tx.split_words(text).alias("tokens"))
    rows = stage(rows, "balanced-words")
    means = vector_unwrap(sentence_embedding(rows, word2vec_fit(rows, "tokens", size, window, min_count, seed=seed)), "embedding", size)
    return stage(rows.drop("tokens").join(means.select("unique_id", "features"), "unique_id"), "word2vec-features")


def embedding_parts(df: DataFrame, vector: str = "embedding", balance: str = "before", seed: int = 42) -> Parts:
    """(unique_id, label, features) from stored vectors."""
    parts = split_and_balance(df, balance=balance, seed=seed)
    return parts_of(vector_unwrap(parts, vector).select("unique_id", "label", "split", "features"))


def random_forest_holdout(parts: Parts, trees: Iterable[int] = range(100, 1001, 100), **options) -> Outcome:
    """Choose the number of trees on the validation part, score the choice on the test part.

    One forest of the largest size is grown on the training part; every choice is a prefix of it.
    """
    trees = list(trees)
    forest = models.rf_grow(parts.train, max(trees), **options)
    return Outcome(*models.tune_and_test(
        *parts,
        tune=lambda train, val: models.rf_tune_holdout(train, val, trees, forest),
        predict=lambda t, train, test: forest.predict(test, t),
    ))


def kmeans_holdout(
    parts: Parts, ks: Iterable[int] = range(2, 11), mapping: str = "majority", seed: int = 42, n_init: int = 1
) -> Outcome:
    """Choose k on the validation part, score the choice on the test part."""

    def predict(k: int, train: DataFrame, test: DataFrame) -> DataFrame:
        model = models.kmeans_fit(train, k, seed=seed, n_init=n_init)
        return models.kmeans_predict(model, train, test, mapping)

    return Outcome(*models.tune_and_test(
        *parts,
        tune=lambda train, val: models.kmeans_tune_holdout(train, val, ks, mapping, seed=seed, n_init=n_init),
        predict=predict,
    ))


def forest_grid(
    parts: Parts, trees: Sequence[int] = (20, 50), depths: Sequence[int | None] = (None, 5, 10), folds: int = 3, seed: int = 42
) -> DataFrame:
    """(trees, depth, metric, value): mean accuracy of the folds for each grid value, and the scores of the best one, fitted on
    the training and validation part, on the test part. Unlimited depth is told as the largest there is."""
    both = parts.train.unionByName(parts.val)
    fitted = models.rf_tune_cv(both, trees, depths, folds=folds, seed=seed)
    grid = models.cv_results(fitted)
    rows = [(int(r["numTrees"]), int(r["maxDepth"]), "accuracy", float(r["accuracy"])) for r in grid]
    best = max(grid, key=lambda r: r["accuracy"])
    scores = test_scores(fitted.best.predict(parts.test)).collect()  # a few scores
    rows += [(int(best["numTrees"]), int(best["maxDepth"]), r["metric"], r["value"]) for r in scores]
    return both.sparkSession.createDataFrame(rows, "trees int, depth int, metric string, value double").coalesce(1)


def test_scores(predictions: DataFrame, prefix: str = "") -> DataFrame:
    """(param, metric, value): accuracy, precision and recall on the test part."""
    found = metrics.precision_recall(predictions).first().asDict() | metrics.accuracy(predictions).first().asDict()
    return models.results_table(predictions, [(0, f"{prefix}test {name}", value or 0.0) for name, value in sorted(found.items())])


def fold_reports(predictions: DataFrame, label: str = "label") -> DataFrame:
    """(fold, class, precision, recall, f1, support, true_negatives, false_positives, false_negatives, true_positives) per fold and class.

    Fold -1 has the means over the folds. All cells of all folds are counted in one pass.
    """
    hit, actual, named = (F.col(label) == F.col("prediction")), F.col(label), F.col("prediction")
    counts = []
    for c in (0, 1):
        counts += [F.count_if((actual == c) & hit).alias(f"tp{c}"), F.count_if((actual != c) & (named == c)).alias(f"fp{c}"),
                   F.count_if((actual == c) & ~hit).alias(f"fn{c}"), F.count_if((actual != c) & (named != c)).alias(f"tn{c}")]
    cells = predictions.groupBy("fold").agg(*counts)
    classes = F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), *[F.col(f"{n}{c}").cast("double").alias(n) for n in ("tp", "fp", "fn", "tn")]) for c in (0, 1)
    ]))
    each = cells.select(F.col("fold").cast("int").alias("fold"), classes)
    share = lambda top, bottom: F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    report = each.select(
        "fold", "class", share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"), F.col("tn").alias("true_negatives"), fp.alias("false_positives"), fn.alias("false_negatives"),
        tp.alias("true_positives"),
    )
    means = report.groupBy("class").agg(*[F.avg(c).alias(c) for c in report.columns[2:]]).withColumn("fold", F.lit(-1))
    return report.unionByName(means.select(report.columns))


def baseline(parts: Parts) -> DataFrame:
    """Majority-class predictions of the test part."""
    return models.baseline_majority(parts.train, parts.test)
