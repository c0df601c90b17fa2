"""Inputs of the queries: DataFrames, and the same tables as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.stopwords import default_stopwords
from corpusmill.operators import itemsets as it
from corpusmill.operators.sampling import balance_undersample
from corpusmill.sources.staging import spread

SEED = 42
SUPPORT = 0.10  # share of the baskets, for items, pairs and triplets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts. ``corpusmill.scanPartitions`` spreads them after the scan, for a local run on one unsplittable file."""
    docs, partitions = table(spark, sf_dir, "documents"), spark.conf.get("corpusmill.scanPartitions", None)
    return spread(docs, "doc_id", int(partitions)) if partitions else docs


def stopwords() -> list[str]:
    return list(default_stopwords())


# --- posts: the raw shape, with missing values, blanks and short copies put in by rule -------

V_POSTS = """v_posts AS (
  SELECT CASE WHEN d.doc_id % 97 = 5 THEN NULL ELSE d.doc_id END AS row_id,
         d.source AS subreddit,
         CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE d.lang END AS title,
         CASE WHEN d.doc_id % 23 = 0 THEN NULL
              WHEN d.doc_id % 29 = 0 THEN '   '
              WHEN d.doc_id % 31 = 0 THEN 'I need help' ELSE d.text END AS body,
         NULLIF(d.n_chars % 7, 3) AS upvotes,
         CAST(1500000000 + d.doc_id * 60 AS BIGINT) AS created_utc,
         NULLIF(d.n_chars % 5, 0) AS num_comments,
         l.quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, chars = F.col("doc_id"), F.col("n_chars")
    body = (
        F.when(i % 23 == 0, None).when(i % 29 == 0, "   ").when(i % 31 == 0, "I need help").otherwise(F.col("text"))
    )
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select(
        F.when(i % 97 != 5, i).alias("row_id"),
        F.col("source").alias("subreddit"),
        F.when(i % 17 != 0, F.col("lang")).alias("title"),
        body.alias("body"),
        F.nullif(chars % 7, F.lit(3)).alias("upvotes"),
        (1500000000 + i * 60).alias("created_utc"),
        F.nullif(chars % 5, F.lit(0)).alias("num_comments"),
        F.col("quality").alias("label"),
    )


# Posts that have a text and a row key.
V_USABLE = f"""{V_POSTS}, v_usable AS (
  SELECT * FROM v_posts WHERE row_id IS NOT NULL AND regexp_matches(body, '{tx.NON_SPACE}'))"""


def usable_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where(F.col("row_id").isNotNull() & tx.is_nonblank("body"))


# --- labelled texts --------------------------------------------------------------------------

V_LABELLED = """v_labelled AS (
  SELECT d.doc_id AS unique_id, d.text AS body, l.quality AS label, l.toxic AS label2
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return joined.select(
        F.col("doc_id").alias("unique_id"), F.col("text").alias("body"),
        F.col("quality").alias("label"), F.col("toxic").alias("label2"),
    )


def all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a label or without; a null text is empty."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("unique_id"), F.coalesce("text", F.lit("")).alias("body"))


# --- baskets and what is frequent in them ----------------------------------------------------

NORMALIZED = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')"
_ITEMS_SQL = (
    "list_sort(list_distinct(list_filter(string_split({0}, ' '), "
    r"lambda t: length(t) > 2 AND regexp_matches(t, '^\p{{L}}+$') AND t NOT IN (@STOPWORDS@))))"
)


def items_sql(text: str) -> str:
    return _ITEMS_SQL.format(NORMALIZED.format(text))


V_BASKETS = f"""{V_LABELLED}, v_items AS (
  SELECT unique_id, label, unnest({items_sql('body')}) AS item FROM v_labelled),
v_support AS (SELECT CAST(ceil({SUPPORT} * count(*)) AS BIGINT) AS s FROM v_labelled)"""
V_DOC_ITEMS = f"""v_items AS (
  SELECT doc_id AS unique_id, unnest({items_sql('text')}) AS item FROM documents)"""

# All documents, with a label where there is one; and as many labelled ones of either class as the smaller has.
V_ALL = """v_all AS (
  SELECT d.doc_id AS unique_id, d.text AS body, l.quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
V_BALANCED = f"""{V_LABELLED}, v_classes AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(unique_id AS VARCHAR), ':{SEED}')), unique_id) AS place
  FROM v_labelled),
v_balanced AS (
  SELECT unique_id, body, label FROM v_classes
  WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM v_labelled GROUP BY label)))"""


def _mined(tables: str, source: str) -> str:
    """CTEs of all mining passes over one table of (unique_id, body, label)."""
    return f"""{tables}, v_items AS (
  SELECT unique_id, label, unnest({items_sql('body')}) AS item FROM {source}),
v_support AS (SELECT CAST(ceil({SUPPORT} * count(*)) AS BIGINT) AS s FROM {source}),
f_items AS (
  SELECT item, count(*) AS cnt FROM v_items GROUP BY item HAVING count(*) >= (SELECT s FROM v_support)),
v_frequent AS (SELECT * FROM v_items WHERE item IN (SELECT item FROM f_items)),
v_pairs AS (
  SELECT x.unique_id, x.label, x.item AS a, y.item AS b
  FROM v_frequent x JOIN v_frequent y ON x.unique_id = y.unique_id AND x.item < y.item),
c_pairs AS (SELECT a, b, count(*) AS cnt FROM v_pairs GROUP BY a, b),
f_pairs AS (SELECT * FROM c_pairs WHERE cnt >= (SELECT s FROM v_support)),
v_triplets AS (
  SELECT p.unique_id, p.label, p.a, p.b, z.item AS c
  FROM v_pairs p JOIN f_pairs ab ON p.a = ab.a AND p.b = ab.b
  JOIN v_frequent z ON p.unique_id = z.unique_id AND z.item > p.b
  JOIN f_pairs ac ON p.a = ac.a AND z.item = ac.b
  JOIN f_pairs bc ON p.b = bc.a AND z.item = bc.b),
c_triplets AS (
  SELECT a, b, c, count(*) AS cnt, count(*) FILTER (label = 1) AS cnt_1, count(*) FILTER (label = 0) AS cnt_0
  FROM v_triplets GROUP BY a, b, c),
f_triplets AS (SELECT * FROM c_triplets WHERE cnt >= (SELECT s FROM v_support))"""


V_MINED = _mined(V_ALL, "v_all")
V_CONTRAST = _mined(V_BALANCED, "v_balanced")


def labelled_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return it.baskets(labelled(spark, sf_dir), "body", stopwords())


def all_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets of all documents; the label is NULL where a document has none."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = documents(spark, sf_dir).join(labels, "doc_id", "left").withColumnRenamed("doc_id", "unique_id")
    return it.baskets(docs, "text", stopwords())


def balanced_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets of as many labelled documents of either class as the smaller class has."""
    return it.baskets(balance_undersample(labelled(spark, sf_dir), seed=SEED), "body", stopwords())


def document_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_baskets(spark, sf_dir).drop("label")


# --- dense vectors ---------------------------------------------------------------------------

V_VEC = """v_vec AS (
  SELECT vec_id AS unique_id, embedding, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label,
         label % 3 AS cluster, CAST(embedding[1] AS DOUBLE) AS score,
         CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS prediction
  FROM embeddings)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("embedding")[0]
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("unique_id"),
        "embedding",
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"),
        (F.col("label") % 3).alias("cluster"),
        first.cast("double").alias("score"),
        F.when(first > 0, 1).otherwise(0).alias("prediction"),
    )


# --- hash order ------------------------------------------------------------------------------


def hash_order_sql(id_col: str = "unique_id") -> str:
    return f"md5(concat(CAST({id_col} AS VARCHAR), ':{SEED}')), {id_col}"


def split_sql(source: str) -> str:
    """CTE ``v_split``: ``source`` with a 70/30 hold-out column."""
    return f"""v_ranked AS (
  SELECT *, row_number() OVER (ORDER BY {hash_order_sql()}) AS rn, count(*) OVER () AS n FROM {source}),
v_split AS (
  SELECT *, CASE WHEN rn <= n - ceil(CAST(0.3 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM v_ranked)"""
