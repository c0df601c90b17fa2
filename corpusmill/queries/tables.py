"""Profiles, cleaning, de-duplication, joins, aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import aggregates as ag
from corpusmill.operators import clean, dedup, itemsets, joins, models, profile, ranks
from corpusmill.operators.rows import explode_values
from corpusmill.queries import views as v
from corpusmill.queries.registry import query
from corpusmill.sources.chunks import order_by_chunk
from corpusmill.sources.staging import stage

COLUMNS = ["row_id", "subreddit", "title", "body", "upvotes", "created_utc", "num_comments", "label"]
TYPES = dict(zip(COLUMNS, ["bigint", "string", "string", "string", "bigint", "bigint", "bigint", "int"]))
ALLOWED = ["src0", "src1", "src2", "src3", "src4"]
IN_ALLOWED = "('src0', 'src1', 'src2', 'src3', 'src4')"


def _posts_sql(select: str) -> str:
    return f"WITH {v.V_POSTS} {select}"


def _usable_sql(select: str) -> str:
    return f"WITH {v.V_USABLE} {select}"


def _each(select: str, columns=COLUMNS) -> str:
    return _posts_sql(" UNION ALL ".join(select.format(c=c, t=TYPES[c]) for c in columns))


# --- profiles --------------------------------------------------------------------------------


@query("profile_nonnull", _each("SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS n_nonnull FROM v_posts"))
def profile_nonnull(spark, d):
    return profile.profile_nonnull(v.posts(spark, d))


@query("profile_distinct", _each(
    "SELECT '{c}' AS column_name, count(DISTINCT {c}) + CAST(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
    " AS n_distinct FROM v_posts"))
def profile_distinct(spark, d):
    return profile.profile_distinct(v.posts(spark, d))


@query("profile_values", _each(
    "SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM v_posts"))
def profile_values(spark, d):
    posts = v.posts(spark, d)
    return profile.profile_values(posts, posts.columns)


@query("profile_nulls", _each("SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM v_posts"))
def profile_nulls(spark, d):
    return profile.profile_nulls(v.posts(spark, d))


@query("rows_with_any_null", _posts_sql(
    "SELECT count(*) AS n_rows FROM v_posts WHERE " + " OR ".join(f"{c} IS NULL" for c in COLUMNS)))
def rows_with_any_null(spark, d):
    return profile.rows_with_any_null(v.posts(spark, d))


@query("exists_value", _posts_sql("SELECT coalesce(bool_or(upvotes = 0), false) AS found FROM v_posts"))
def exists_value(spark, d):
    return profile.exists_value(v.posts(spark, d), "upvotes", 0)


@query("row_count", _posts_sql("SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns FROM v_posts"))
def row_count(spark, d):
    return profile.row_count(v.posts(spark, d))


@query("head_n", _usable_sql("SELECT row_id, subreddit, title, body FROM v_usable ORDER BY row_id LIMIT 5"))
def head_n(spark, d):
    return profile.head_n(v.usable_posts(spark, d).select("row_id", "subreddit", "title", "body"), "row_id")


@query("count_pattern", f"""
SELECT CAST(sum(len(regexp_extract_all(text, '\\t'))) AS BIGINT) AS n_tabs,
       CAST(sum(len(regexp_extract_all(text, '[{tx.SPACES}]{{2,}}'))) AS BIGINT) AS n_runs FROM documents""")
def count_pattern(spark, d):
    return profile.count_pattern(
        v.table(spark, d, "documents"), "text", {"n_tabs": r"\t", "n_runs": f"[{tx.SPACES}]{{2,}}"})


@query("count_nonblank", _posts_sql(
    f"SELECT count(*) AS n_nonblank FROM v_posts WHERE regexp_matches(body, '{tx.NON_SPACE}')"))
def count_nonblank(spark, d):
    return profile.count_nonblank(v.posts(spark, d), "body")


# --- filters, casts, projections -------------------------------------------------------------


@query("drop_null_subset", _posts_sql("SELECT * FROM v_posts WHERE title IS NOT NULL AND label IS NOT NULL"))
def drop_null_subset(spark, d):
    return clean.drop_null_subset(v.posts(spark, d), ["title", "label"])


@query("filter_nonblank", _posts_sql(
    f"SELECT row_id, body FROM v_posts WHERE regexp_matches(body, '{tx.NON_SPACE}')"))
def filter_nonblank(spark, d):
    return clean.filter_nonblank(v.posts(spark, d), "body").select("row_id", "body")


@query("drop_all_null", _posts_sql("""SELECT * FROM v_posts
WHERE title IS NOT NULL OR body IS NOT NULL OR created_utc IS NOT NULL OR upvotes IS NOT NULL OR num_comments IS NOT NULL OR label IS NOT NULL"""))
def drop_all_null(spark, d):
    return clean.drop_all_null(v.posts(spark, d), ignore=["subreddit", "row_id"])


@query("fill_null", _posts_sql("SELECT created_utc, coalesce(num_comments, 0) AS num_comments FROM v_posts"))
def fill_null(spark, d):
    return clean.fill_null(v.posts(spark, d), "num_comments", 0).select("created_utc", "num_comments")


@query("cast_nullable_int", _posts_sql("SELECT created_utc, upvotes, num_comments, CAST(label AS BIGINT) AS label FROM v_posts"))
def cast_nullable_int(spark, d):
    floats = v.posts(spark, d).select(
        "created_utc", *[F.col(c).cast("double").alias(c) for c in ("upvotes", "num_comments", "label")])
    return clean.cast_nullable_int(floats, ["upvotes", "num_comments", "label"])


@query("coerce_numeric", """SELECT doc_id, TRY_CAST(CASE WHEN lang = 'en' THEN source ELSE substr(source, 4) END AS DOUBLE)
AS number FROM documents""")
def coerce_numeric(spark, d):
    mixed = F.when(F.col("lang") == "en", F.col("source")).otherwise(F.expr("substr(source, 4)"))
    return clean.coerce_numeric(v.table(spark, d, "documents").select("doc_id", mixed.alias("number")), "number")


@query("epoch_to_timestamp", _posts_sql(
    "SELECT row_id, make_timestamp(created_utc * 1000000) AS created_datetime FROM v_posts"))
def epoch_to_timestamp(spark, d):
    return clean.epoch_to_timestamp(v.posts(spark, d).select("row_id", "created_utc"))


@query("project_columns", _posts_sql("SELECT body, label FROM v_posts"))
def project_columns(spark, d):
    return clean.project_columns(v.posts(spark, d), ["body", "label"])


@query("drop_columns", _posts_sql("SELECT row_id, subreddit, title, body, label FROM v_posts"))
def drop_columns(spark, d):
    return clean.drop_columns(v.posts(spark, d), ["upvotes", "num_comments", "created_utc", "not_there"])


@query("rename_columns", _posts_sql('SELECT row_id AS "index", subreddit AS category, label FROM v_posts'))
def rename_columns(spark, d):
    some = v.posts(spark, d).select("row_id", "subreddit", "label")
    return clean.rename_columns(some, {"row_id": "index", "subreddit": "category"})


@query("filter_in_list", _posts_sql(f"SELECT * FROM v_posts WHERE subreddit IN {IN_ALLOWED}"))
def filter_in_list(spark, d):
    return clean.filter_in_list(v.posts(spark, d), "subreddit", ALLOWED)


@query("filter_eq", _posts_sql("SELECT * FROM v_posts WHERE label = 1"))
def filter_eq(spark, d):
    return clean.filter_eq(v.posts(spark, d), "label", 1)


@query("assign_row_key", _usable_sql(
    "SELECT row_id, body, row_number() OVER (ORDER BY row_id) - 1 AS unique_id FROM v_usable"))
def assign_row_key(spark, d):
    return ranks.assign_row_key(v.usable_posts(spark, d).select("row_id", "body"), "row_id")


# --- de-duplication --------------------------------------------------------------------------

V_COPIES = f"""{v.V_USABLE}, v_copies AS (
  SELECT *, count(*) OVER (PARTITION BY body) AS n_copies,
         row_number() OVER (PARTITION BY body ORDER BY row_id) AS rn,
         len(regexp_extract_all(body, '{tx.WORD_RUN}')) AS words FROM v_usable)"""


@query("duplicate_flag", f"WITH {V_COPIES} SELECT row_id, n_copies > 1 AS is_duplicate FROM v_copies")
def duplicate_flag(spark, d):
    return dedup.duplicate_flag(v.usable_posts(spark, d)).select("row_id", "is_duplicate")


@query("word_count", f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{tx.WORD_RUN}')) AS INTEGER) AS word_count
FROM documents""")
def word_count(spark, d):
    return v.table(spark, d, "documents").select("doc_id", tx.word_count("text").alias("word_count"))


@query("dedup_short_long_split", f"""WITH {V_COPIES}
SELECT row_id, CAST(words AS INTEGER) AS word_count, CASE WHEN words <= 5 THEN 'short' ELSE 'long' END AS kind
FROM v_copies WHERE n_copies > 1""")
def dedup_short_long_split(spark, d):
    return dedup.dedup_short_long_split(v.usable_posts(spark, d)).select("row_id", "word_count", "kind")


@query("dedup_keep_first", f"WITH {V_COPIES} SELECT row_id, subreddit, body FROM v_copies WHERE rn = 1")
def dedup_keep_first(spark, d):
    return dedup.dedup_keep_first(v.usable_posts(spark, d).select("row_id", "subreddit", "body"))


@query("dedup_full_row", "SELECT DISTINCT * FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id % 3 = 0)")
def dedup_full_row(spark, d):
    docs = v.table(spark, d, "documents")
    return dedup.dedup_full_row(docs.unionByName(docs.where("doc_id % 3 = 0")))


@query("dedup_length_aware", f"""WITH {V_COPIES}
SELECT row_id, subreddit, body, label,
       row_number() OVER (ORDER BY CASE WHEN n_copies > 1 AND words > 5 THEN 1 ELSE 0 END, row_id) - 1 AS unique_id
FROM v_copies WHERE n_copies = 1 OR words <= 5 OR rn = 1""")
def dedup_length_aware(spark, d):
    return dedup.dedup_length_aware(v.usable_posts(spark, d).select("row_id", "subreddit", "body", "label"))


# --- joins and lookups -----------------------------------------------------------------------


@query("join_left_key", """SELECT d.doc_id, d.source, d.text, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_left_key(spark, d):
    left = v.table(spark, d, "documents").select("doc_id", "source", "text")
    return joins.join_left_key(left, v.table(spark, d, "labels"), "doc_id", ["quality"])


@query("join_features_labels", f"""WITH {v.V_VEC}
SELECT unique_id, label, len(embedding) AS size, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM v_vec""")
def join_features_labels(spark, d):
    both = v.vectors(spark, d)
    joined = joins.join_features_labels(both.select("unique_id", "embedding"), both.select("unique_id", "label"))
    return joined.select(
        "unique_id", "label", F.size("embedding").cast("long").alias("size"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"))


@query("nearest_to_center", f"""WITH {v.V_VEC}, e AS (
  SELECT unique_id, cluster, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS pos FROM v_vec),
centers AS (SELECT cluster, pos, avg(x) AS c FROM e GROUP BY cluster, pos),
dist AS (SELECT k.cluster, e.unique_id, sqrt(sum((e.x - k.c) * (e.x - k.c))) AS distance
         FROM e JOIN centers k ON e.pos = k.pos GROUP BY k.cluster, e.unique_id)
SELECT cluster, unique_id, round(distance, 6) AS distance
FROM dist QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY distance, unique_id) = 1""")
def nearest_to_center(spark, d):
    points = v.vectors(spark, d)
    found = joins.nearest_to_center(points, cluster_means(points))
    return found.withColumn("distance", F.round("distance", 6))


def cluster_means(points, clusters: int = 3):
    """Mean vector of each of the few clusters, in cluster order."""
    long = points.select("cluster", F.posexplode("embedding").alias("pos", "x"))
    means = long.groupBy("cluster", "pos").agg(F.avg(F.col("x").cast("double")).alias("c"))
    rows = means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "c"))).alias("v")).collect()
    by_cluster = {r["cluster"]: [p["c"] for p in r["v"]] for r in rows}
    return [by_cluster[c] for c in range(clusters)]


@query("lookup_map", f"""WITH {v.V_VEC}, m AS (
  SELECT cluster, label AS prediction FROM v_vec GROUP BY cluster, label
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, label) = 1)
SELECT unique_id, v_vec.cluster, m.prediction FROM v_vec JOIN m ON v_vec.cluster = m.cluster""")
def lookup_map(spark, d):
    points = v.vectors(spark, d).select("unique_id", "cluster", "label")
    return joins.lookup_map(points.drop("label"), models.map_majority(points), "cluster")


@query("semi_join_frequent", f"WITH {v.V_MINED} SELECT unique_id, item FROM v_frequent")
def semi_join_frequent(spark, d):
    baskets = stage(v.all_baskets(spark, d), "baskets")
    support = itemsets.min_support(baskets.count(), v.SUPPORT)
    frequent = stage(ag.having_support(itemsets.item_counts(baskets), support), "frequent-items")
    tokens = explode_values(baskets, ["unique_id"], "items", "item")
    return joins.semi_join_frequent(tokens, frequent, ["item"])


@query("merge_two_counts", f"""WITH {v.V_BASKETS}
SELECT item, count(*) FILTER (label = 1) AS cnt_1, count(*) FILTER (label = 0) AS cnt_0 FROM v_items GROUP BY item""")
def merge_two_counts(spark, d):
    baskets = v.labelled_baskets(spark, d)
    one, zero = (itemsets.item_counts(baskets.where(F.col("label") == k)) for k in (1, 0))
    return joins.merge_two_counts(one, zero, key="item")


# --- aggregations ----------------------------------------------------------------------------


@query("crosstab_category_label", _posts_sql("""SELECT subreddit, count(*) FILTER (label = 0) AS n_0,
count(*) FILTER (label = 1) AS n_1 FROM v_posts GROUP BY subreddit"""))
def crosstab_category_label(spark, d):
    return ag.crosstab(v.posts(spark, d), "subreddit", "label")


@query("value_counts", _posts_sql("SELECT title, count(*) AS cnt FROM v_posts WHERE title IS NOT NULL GROUP BY title"))
def value_counts(spark, d):
    return ag.value_counts(v.posts(spark, d), "title")


@query("cluster_label_counts", f"""WITH {v.V_VEC} SELECT cluster, count(*) FILTER (label = 0) AS n_0,
count(*) FILTER (label = 1) AS n_1 FROM v_vec GROUP BY cluster""")
def cluster_label_counts(spark, d):
    return ag.crosstab(v.vectors(spark, d), "cluster", "label")


@query("mode_value", _posts_sql("""SELECT title, count(*) AS cnt FROM v_posts WHERE title IS NOT NULL
GROUP BY title ORDER BY cnt DESC, title LIMIT 1"""))
def mode_value(spark, d):
    return ag.mode_value(v.posts(spark, d), "title")


@query("mode_by_group", _posts_sql("""SELECT subreddit, title FROM v_posts WHERE title IS NOT NULL
GROUP BY subreddit, title QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY count(*) DESC, title) = 1"""))
def mode_by_group(spark, d):
    return ag.mode_by_group(v.posts(spark, d), "subreddit", "title")


WORDS_SQL = f"SELECT unnest(list_filter(string_split({v.NORMALIZED.format('text')}, ' '), lambda t: t <> '')) AS word FROM documents"


@query("partial_final_count", f"SELECT word, count(*) AS cnt FROM ({WORDS_SQL}) GROUP BY word")
def partial_final_count(spark, d):
    words = explode_values(v.documents(spark, d), [], tx.tokenize("text", contractions=False), "word")
    return ag.count_by(words, ["word"])


@query("having_support", f"""WITH {v.V_DOC_ITEMS} SELECT item, count(*) AS cnt FROM v_items GROUP BY item
HAVING count(*) >= (SELECT CAST(ceil({v.SUPPORT} * count(*)) AS BIGINT) FROM documents)""")
def having_support(spark, d):
    baskets = v.document_baskets(spark, d)
    return ag.having_support(itemsets.item_counts(baskets), itemsets.min_support(baskets.count(), v.SUPPORT))


@query("mean_scores", f"""WITH {v.V_VEC}, folds AS (
  SELECT cluster, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS score FROM v_vec GROUP BY cluster)
SELECT round(avg(score), 6) AS mean_score FROM folds""")
def mean_scores(spark, d):
    points = v.vectors(spark, d).withColumnRenamed("cluster", "fold")
    return ag.mean_scores(models.fold_scores(points)).select(F.round("mean_score", 6).alias("mean_score"))


# --- top-k and set operations ----------------------------------------------------------------


@query("topk_contrast", f"""WITH {v.V_BASKETS}, c AS (
  SELECT item, count(*) FILTER (label = 1) AS cnt_1, count(*) FILTER (label = 0) AS cnt_0 FROM v_items GROUP BY item)
SELECT item, cnt_1, cnt_0, cnt_1 - cnt_0 AS difference FROM c ORDER BY difference DESC, item LIMIT 10""")
def topk_contrast(spark, d):
    items = explode_values(v.labelled_baskets(spark, d), ["label"], "items", "item")
    return ag.topk_contrast(itemsets.class_counts(items, ["item"]), 10, "item")


@query("argmax_param", """SELECT CAST(user_id AS INTEGER) AS param, CAST(count(*) AS DOUBLE) AS value FROM events
GROUP BY 1 ORDER BY value DESC, param LIMIT 1""")
def argmax_param(spark, d):
    results = v.table(spark, d, "events").groupBy(F.col("user_id").cast("int").alias("param")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return ag.argmax_param(results)


@query("order_by_chunk", """SELECT 'chunk_' || doc_id || '.tsv_out.tsv' AS name, CAST(doc_id AS INTEGER) AS chunk
FROM documents ORDER BY chunk""")
def order_by_chunk_(spark, d):
    name = F.concat(F.lit("chunk_"), F.col("doc_id").cast("string"), F.lit(".tsv_out.tsv")).alias("name")
    return order_by_chunk(v.table(spark, d, "documents").select(name))


@query("union_all", _posts_sql("""SELECT row_id, subreddit, NULL AS label FROM v_posts WHERE label IS NULL
UNION ALL SELECT row_id, subreddit, label FROM v_posts WHERE label IS NOT NULL"""))
def union_all(spark, d):
    some = v.posts(spark, d).select("row_id", "subreddit", "label")
    return ag.union_all(some.where("label IS NOT NULL"), some.where("label IS NULL").drop("label"))


@query("distinct_values", "SELECT DISTINCT source FROM documents")
def distinct_values(spark, d):
    return ag.distinct_values(v.table(spark, d, "documents"), "source")
