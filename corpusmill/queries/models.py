"""Features, clustering, classification, tuning and chart tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import charts, models
from corpusmill.operators import features as ft
from corpusmill.operators import sampling as sm
from corpusmill.operators.aggregates import vector_mean
from corpusmill.operators.rows import explode_values
from corpusmill.plans import classify
from corpusmill.queries import views as v
from corpusmill.queries.registry import query
from corpusmill.queries.tables import cluster_means
from corpusmill.queries.text import NGRAMS_SQL, TERM_TOKENS_SQL
from corpusmill.sources.staging import stage

TREES = range(100, 1001, 100)
STARTS = 10


# --- TF-IDF ----------------------------------------------------------------------------------

V_TERMS = f"""{v.V_LABELLED}, {v.split_sql('v_labelled')}, tok AS (
  SELECT unique_id, label, split, {TERM_TOKENS_SQL.format('body')} AS tok FROM v_split),
terms AS (SELECT unique_id, label, split, unnest({NGRAMS_SQL}) AS term FROM tok),
n AS (SELECT count(*) AS n FROM tok WHERE split = 'train'),
vocabulary AS (
  SELECT term, count(DISTINCT unique_id) AS df FROM terms WHERE split = 'train' GROUP BY term
  HAVING count(DISTINCT unique_id) >= CAST(0.01 AS DOUBLE) * (SELECT n FROM n)),
weights AS (
  SELECT unique_id, t.term, split, count(*) * (ln((1.0 + (SELECT n FROM n)) / (1.0 + df)) + 1.0) AS raw
  FROM terms t JOIN vocabulary USING (term) GROUP BY unique_id, t.term, split, df),
tfidf AS (
  SELECT unique_id, term, split, raw / sqrt(sum(raw * raw) OVER (PARTITION BY unique_id)) AS weight FROM weights)"""


def split_tokens(spark, d):
    parts = sm.split_holdout(v.labelled(spark, d))
    tokens = tx.term_tokens("body", v.stopwords()).alias("tokens")
    return stage(parts.select("unique_id", "label", "split", tokens), "split-tokens")


def _is_train(df):
    return df.where(F.col("split") == "train")


@query("tfidf_vocab_df", f"WITH {V_TERMS} SELECT term, df FROM vocabulary")
def tfidf_vocab_df(spark, d):
    return ft.tfidf_fit(_is_train(split_tokens(spark, d))).vocabulary


@query("tfidf_transform", f"WITH {V_TERMS} SELECT unique_id, term, round(weight, 6) AS weight FROM tfidf")
def tfidf_transform(spark, d):
    parts = split_tokens(spark, d)
    weights = ft.tfidf_fit(_is_train(parts)).transform_long(parts)
    return weights.withColumn("weight", F.round("weight", 6))


@query("tfidf_fit_transform", f"""WITH {V_TERMS} SELECT unique_id, count(term) AS n_terms,
round(coalesce(sum(weight), 0), 6) AS total
FROM tok LEFT JOIN tfidf USING (unique_id) WHERE tok.split = 'train' GROUP BY unique_id""")
def tfidf_fit_transform(spark, d):
    rows = ft.tfidf_fit_transform(_is_train(split_tokens(spark, d)))
    values = rows.select("unique_id", F.filter(vector_to_array("features"), lambda x: x != 0).alias("w"))
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    return values.select("unique_id", F.size("w").cast("long").alias("n_terms"), F.round(total, 6).alias("total"))


# --- word vectors and encoders ---------------------------------------------------------------

_HEX = "CAST(('0x' || substr(md5(word), {0}, 2)) AS BIGINT) / 127.5 - 1.0"
V_WORDS = f"""words AS (
  SELECT doc_id AS unique_id, unnest(list_filter(string_split({v.NORMALIZED.format('text')}, ' '), lambda t: t <> '')) AS word
  FROM documents),
known AS (SELECT word FROM words GROUP BY word HAVING count(*) >= 2)"""


def _all_words(spark, d):
    words = tx.tokenize("body", contractions=False).alias("tokens")
    return stage(v.all_texts(spark, d).select("unique_id", words), "words")


@query("vector_mean", f"""WITH {V_WORDS}, vectors AS (
  SELECT word, [{', '.join(_HEX.format(1 + 2 * i) for i in range(4))}] AS vector FROM known),
sums AS (
  SELECT unique_id, avg(vector[1]) AS v1, avg(vector[2]) AS v2, avg(vector[3]) AS v3, avg(vector[4]) AS v4
  FROM words JOIN vectors USING (word) GROUP BY unique_id)
SELECT unique_id, round(coalesce(v1, 0), 6) AS v1, round(coalesce(v2, 0), 6) AS v2, round(coalesce(v3, 0), 6) AS v3,
       round(coalesce(v4, 0), 6) AS v4 FROM (SELECT doc_id AS unique_id FROM documents) LEFT JOIN sums USING (unique_id)""")
def vector_mean_(spark, d):
    texts = _all_words(spark, d)
    known = explode_values(texts, [], "tokens", "word").groupBy("word").count().where("count >= 2")
    parts = [F.conv(F.substring(F.md5("word"), 1 + 2 * i, 2), 16, 10).cast("double") / 127.5 - 1.0 for i in range(4)]
    vectors = stage(known.select("word", F.array(*parts).alias("vector")), "vectors")
    means = vector_mean(texts, "tokens", vectors, 4)
    return means.select("unique_id", *[F.round(F.col("embedding")[i], 6).alias(f"v{i + 1}") for i in range(4)])


@query("word2vec_fit")
def word2vec_fit(spark, d):
    return ft.word_vectors(ft.word2vec_fit(_all_words(spark, d)))


@query("sentence_embedding")
def sentence_embedding(spark, d):
    texts = _all_words(spark, d)
    return ft.sentence_embedding(texts, ft.word2vec_fit(texts))


def hashing_encoder(size: int = 32):
    """A stand-in encoder for tests: word hashes of the whole text, signed and averaged."""
    from zlib import crc32

    def encode(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), size), dtype=np.float32)
        for i, text in enumerate(texts):
            for word in text.split():
                h = crc32(word.encode())
                out[i, h % size] += 1.0 if h & 0x80000000 else -1.0
        return out / np.maximum(np.abs(out).sum(axis=1, keepdims=True), 1.0)

    return encode


@query("batch_embed")
def batch_embed(spark, d):
    return ft.batch_embed(v.all_texts(spark, d), "body", hashing_encoder)


@query("vector_unwrap", f"""WITH {v.V_VEC} SELECT unique_id, len(embedding) AS size,
round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM v_vec""")
def vector_unwrap(spark, d):
    size = len(v.vectors(spark, d).first()["embedding"])
    rows = ft.vector_unwrap(v.vectors(spark, d), size=size).select("unique_id", vector_to_array("features").alias("f"))
    return rows.select("unique_id", F.size("f").cast("long").alias("size"), F.round(F.col("f")[0], 6).alias("first_value"))


# --- models over the dense vectors -----------------------------------------------------------


def _dense(spark, d):
    rows = v.vectors(spark, d).select("unique_id", "label", "embedding")
    return ft.vector_unwrap(rows).drop("embedding")


def _parts(spark, d):
    return classify.parts_of(sm.split_train_val_test(_dense(spark, d)))


@query("pca_2d")
def pca_2d(spark, d):
    return ft.pca_2d(_dense(spark, d)).select("unique_id", "pc1", "pc2")


@query("kmeans_fit_predict")
def kmeans_fit_predict(spark, d):
    data = _dense(spark, d)
    return models.kmeans_fit(data, 2, n_init=STARTS).transform(data).select("unique_id", "label", "cluster")


@query("cluster_label_identity", f"WITH {v.V_VEC} SELECT unique_id, label, cluster AS prediction FROM v_vec")
def cluster_label_identity(spark, d):
    return models.cluster_label_identity(v.vectors(spark, d)).select("unique_id", "label", "prediction")


V_SPLIT = f"{v.V_VEC}, {v.split_sql('v_vec')}"


def _majority_sql(name: str, source: str) -> str:
    return f"""{name} AS (SELECT cluster, label AS mapped FROM {source} GROUP BY cluster, label
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, label) = 1)"""


def _vec_halves(spark, d):
    parts = sm.split_holdout(v.vectors(spark, d).drop("prediction"))
    return parts.where("split = 'train'").drop("split"), parts.where("split = 'test'").drop("split")


@query("cluster_label_majority", f"""WITH {V_SPLIT}, train AS (SELECT * FROM v_split WHERE split = 'train'),
{_majority_sql('m', 'train')}
SELECT unique_id, label, mapped AS prediction FROM v_split JOIN m USING (cluster) WHERE split = 'test'""")
def cluster_label_majority(spark, d):
    train, test = _vec_halves(spark, d)
    return models.cluster_label_majority(test, train).select("unique_id", "label", "prediction")


@query("cluster_label_majority_eval", f"""WITH {V_SPLIT}, test AS (SELECT * FROM v_split WHERE split = 'test'),
{_majority_sql('m', 'test')} SELECT unique_id, label, mapped AS prediction FROM test JOIN m USING (cluster)""")
def cluster_label_majority_eval(spark, d):
    _, test = _vec_halves(spark, d)
    return models.cluster_label_majority_eval(test).select("unique_id", "label", "prediction")


@query("cluster_label_nearest", f"""WITH {V_SPLIT}, e AS (
  SELECT unique_id, split, label, cluster, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS pos
  FROM v_split),
centers AS (SELECT cluster, pos, avg(x) AS c FROM e WHERE split = 'train' GROUP BY cluster, pos),
dist AS (SELECT k.cluster, e.unique_id, e.label, sum((e.x - k.c) * (e.x - k.c)) AS d2
         FROM e JOIN centers k ON e.pos = k.pos WHERE split = 'train' GROUP BY k.cluster, e.unique_id, e.label),
m AS (SELECT cluster, label AS mapped FROM dist
      QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY d2, unique_id) = 1)
SELECT unique_id, label, mapped AS prediction FROM v_split JOIN m USING (cluster) WHERE split = 'test'""")
def cluster_label_nearest(spark, d):
    train, test = _vec_halves(spark, d)
    centers = cluster_means(train)
    return models.cluster_label_nearest(test, train, centers).select("unique_id", "label", "prediction")


@query("kmeans_tune_holdout")
def kmeans_tune_holdout(spark, d):
    parts = _parts(spark, d)
    return models.kmeans_tune_holdout(parts.train, parts.val, mapping="nearest", n_init=STARTS)


@query("kmeans_elbow")
def kmeans_elbow(spark, d):
    return models.kmeans_elbow(_dense(spark, d), n_init=STARTS)


@query("kmeans_silhouette")
def kmeans_silhouette(spark, d):
    return models.kmeans_silhouette(_dense(spark, d), n_init=STARTS)


@query("rf_fit_predict")
def rf_fit_predict(spark, d):
    parts = _parts(spark, d)
    return models.rf_fit_predict(parts.train, parts.test).select("unique_id", "label", "prediction", "score")


@query("rf_tune_holdout")
def rf_tune_holdout(spark, d):
    parts = _parts(spark, d)
    return models.rf_tune_holdout(parts.train, parts.val, TREES)


@query("rf_tune_cv")
def rf_tune_cv(spark, d):
    parts = _parts(spark, d)
    fitted = models.rf_tune_cv(parts.train.unionByName(parts.val))
    rows = [(i, r["numTrees"], r["maxDepth"], float(r["accuracy"])) for i, r in enumerate(models.cv_results(fitted))]
    return spark.createDataFrame(rows, "param int, trees int, depth int, accuracy double")


@query("cv_stratified")
def cv_stratified(spark, d):
    balanced = sm.balance_undersample(_dense(spark, d))
    return models.cv_stratified(balanced, trees=100, depth=models.UNLIMITED_DEPTH)


@query("baseline_majority", f"""WITH {V_SPLIT} SELECT unique_id, label, (
  SELECT label FROM v_split WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS prediction
FROM v_split WHERE split = 'test'""")
def baseline_majority(spark, d):
    train, test = _vec_halves(spark, d)
    return models.baseline_majority(train, test).select("unique_id", "label", "prediction")


@query("results_table")
def results_table(spark, d):
    return classify.kmeans_holdout(_parts(spark, d), mapping="nearest", n_init=STARTS).results


# --- whole runs, from text to the score on the test part --------------------------------------


@query("tfidf_kmeans_holdout")
def tfidf_kmeans_holdout(spark, d):
    parts = classify.tfidf_parts(v.labelled(spark, d), "body", v.stopwords())
    return classify.kmeans_holdout(parts, ks=range(2, 11), n_init=STARTS).results


@query("triplet_forest_holdout")
def triplet_forest_holdout(spark, d):
    supports = (v.SUPPORT,) * 3
    parts = classify.triplet_parts(v.labelled(spark, d), "body", v.stopwords(), supports, balance="both")
    return classify.random_forest_holdout(parts, trees=TREES).results


def _triplet_parts(spark, d):
    return classify.triplet_parts(v.labelled(spark, d), "body", v.stopwords(), (v.SUPPORT,) * 3, balance="both")


@query("triplet_forest_grid")
def triplet_forest_grid(spark, d):
    """A grid of trees and depths by 3 folds over train and validation, refitted on both, scored on the test part."""
    return classify.forest_grid(_triplet_parts(spark, d))


@query("triplet_kmeans_holdout")
def triplet_kmeans_holdout(spark, d):
    """k by the validation part; accuracy, precision and recall of the choice, and of the baseline, on the test part."""
    parts = _triplet_parts(spark, d)
    outcome = classify.kmeans_holdout(parts, ks=range(2, 11), n_init=STARTS)
    return outcome.results.unionByName(classify.test_scores(outcome.predictions)).unionByName(
        classify.test_scores(classify.baseline(parts), "baseline "))


@query("word2vec_cv_report")
def word2vec_cv_report(spark, d):
    """Ten folds over balanced averaged word vectors: the report of each fold, and the mean of the folds."""
    vectors = classify.word2vec_features(v.labelled(spark, d), "body")
    return classify.fold_reports(models.cv_stratified(vectors, trees=100, depth=models.UNLIMITED_DEPTH))


@query("word2vec_components_kmeans")
def word2vec_components_kmeans(spark, d):
    """Clusters of the two components of the averaged word vectors."""
    vectors = classify.word2vec_features(v.labelled(spark, d), "body")
    points = stage(ft.vector_unwrap(ft.pca_2d(vectors).select("unique_id", "label", F.array("pc1", "pc2").alias("embedding"))), "components")
    found = models.kmeans_fit(points, 2, n_init=STARTS).transform(points)
    return found.select("unique_id", "label", F.col("embedding")[0].alias("pc1"), F.col("embedding")[1].alias("pc2"), "cluster")


@query("tfidf_forest_holdout")
def tfidf_forest_holdout(spark, d):
    parts = classify.tfidf_parts(v.labelled(spark, d), "body", v.stopwords())
    return classify.random_forest_holdout(parts, trees=TREES).results


@query("word2vec_forest_holdout")
def word2vec_forest_holdout(spark, d):
    parts = classify.word2vec_parts(v.labelled(spark, d), "body")
    return classify.random_forest_holdout(parts, trees=(100,), depth=models.UNLIMITED_DEPTH).results


@query("embedding_kmeans_holdout")
def embedding_kmeans_holdout(spark, d):
    parts = classify.embedding_parts(v.vectors(spark, d).select("unique_id", "label", "embedding"))
    return classify.kmeans_holdout(parts, n_init=STARTS).results


@query("embedding_forest_holdout")
def embedding_forest_holdout(spark, d):
    parts = classify.embedding_parts(v.vectors(spark, d).select("unique_id", "label", "embedding"))
    return classify.random_forest_holdout(parts, trees=range(100, 901, 100)).results


@query("embedding_baseline")
def embedding_baseline(spark, d):
    parts = classify.embedding_parts(v.vectors(spark, d).select("unique_id", "label", "embedding"))
    return classify.baseline(parts).select("unique_id", "label", "prediction")


# --- chart tables ----------------------------------------------------------------------------


@query("chart_posts_per_category", f"WITH {v.V_POSTS} SELECT subreddit, count(*) AS cnt FROM v_posts GROUP BY subreddit")
def chart_posts_per_category(spark, d):
    return charts.posts_per_category(v.posts(spark, d), "subreddit")


@query("chart_elbow")
def chart_elbow(spark, d):
    return charts.elbow(models.kmeans_elbow(_dense(spark, d), n_init=STARTS))


@query("chart_cluster_scatter")
def chart_cluster_scatter(spark, d):
    data = _dense(spark, d)
    return charts.cluster_scatter(models.kmeans_fit(data, 3, n_init=STARTS).transform(data))


@query("chart_cluster_distribution", f"""WITH {v.V_VEC} SELECT cluster, count(*) FILTER (label = 0) AS n_0,
count(*) FILTER (label = 1) AS n_1 FROM v_vec GROUP BY cluster""")
def chart_cluster_distribution(spark, d):
    return charts.cluster_distribution(v.vectors(spark, d))


@query("chart_holdout_curve")
def chart_holdout_curve(spark, d):
    parts = _parts(spark, d)
    return charts.holdout_curve(models.rf_tune_holdout(parts.train, parts.val, TREES))
