"""Frequent items, pairs and triplets, their contrast, and the indicator features."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import charts
from corpusmill.operators import features as ft
from corpusmill.operators import itemsets as it
from corpusmill.operators.aggregates import having_support
from corpusmill.plans import contrast
from corpusmill.queries import views as v
from corpusmill.queries.registry import query
from corpusmill.sources.staging import stage

BUCKETS = 1000
SUPPORTS = (v.SUPPORT,) * 3
RESIDUE = f"CAST(('0x' || substr(md5({{0}}), 1, 8)) AS BIGINT) % {BUCKETS}"
# Share of the pair occurrences that makes a bucket frequent: just above an even spread.
BUCKET_SHARE = 1.0 / BUCKETS


def first_pass(spark, d):
    return contrast.first_pass(v.all_baskets(spark, d), v.SUPPORT)


def mined(spark, d):
    """All passes over all documents."""
    return contrast.mine(v.all_baskets(spark, d), *SUPPORTS)


def balanced(spark, d):
    """All passes over balanced classes, as contrasts of counts need them."""
    return contrast.mine(v.balanced_baskets(spark, d), *SUPPORTS)


def _mined_sql(select: str) -> str:
    return f"WITH {v.V_MINED} {select}"


def _contrast_sql(select: str) -> str:
    return f"WITH {v.V_CONTRAST} {select}"


def _mark(*names: str):
    """A digest of the rows of a group that both engines can sum: 28 bits of an MD5."""
    return F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *names)), 1, 7), 16, 10).cast("bigint"))


def _mark_sql(names: str) -> str:
    return f"CAST(sum(CAST(('0x' || substr(md5({names}), 1, 7)) AS BIGINT)) AS BIGINT)"


@query("self_join_pairs", _mined_sql(f"""SELECT unique_id, count(*) AS n_pairs, {_mark_sql("a || '|' || b")} AS mark
FROM v_pairs GROUP BY unique_id"""))
def self_join_pairs(spark, d):
    """The pairs of each basket, as their number and a digest of them."""
    pairs = it.basket_pairs(first_pass(spark, d).baskets)
    return pairs.groupBy("unique_id").agg(F.count(F.lit(1)).alias("n_pairs"), _mark("a", "b").alias("mark"))


@query("self_join_triplets", _mined_sql(f"""SELECT unique_id, count(*) AS n_triplets,
{_mark_sql("a || '|' || b || '|' || c")} AS mark FROM v_triplets GROUP BY unique_id"""))
def self_join_triplets(spark, d):
    """The candidate triplets of each basket, as their number and a digest of them."""
    first = first_pass(spark, d)
    found = it.candidate_triplets(first.baskets, contrast.second_pass(first, v.SUPPORT))
    return found.groupBy("unique_id").agg(F.count(F.lit(1)).alias("n_triplets"), _mark("a", "b", "c").alias("mark"))


@query("contains_itemset", _mined_sql("SELECT unique_id, a, b, c FROM v_triplets JOIN f_triplets USING (a, b, c)"))
def contains_itemset(spark, d):
    m = mined(spark, d)
    return it.triplet_matches(m.baskets, m.triplets).drop("label")


@query("pcy_item_counts", f"WITH {v.V_DOC_ITEMS} SELECT item, count(*) AS cnt FROM v_items GROUP BY item")
def pcy_item_counts(spark, d):
    return it.item_counts(v.document_baskets(spark, d))


V_BUCKETS = f"""{v.V_DOC_ITEMS}, v_hashed AS (
  SELECT unique_id, {RESIDUE.format('item')} AS h, row_number() OVER (PARTITION BY unique_id ORDER BY item) AS pos
  FROM v_items),
v_buckets AS (
  SELECT CAST((x.h + y.h) % {BUCKETS} AS INTEGER) AS bucket, count(*) AS cnt
  FROM v_hashed x JOIN v_hashed y ON x.unique_id = y.unique_id AND x.pos < y.pos GROUP BY 1)"""


@query("pcy_bucket_counts", f"WITH {V_BUCKETS} SELECT bucket, cnt FROM v_buckets")
def pcy_bucket_counts(spark, d):
    return it.bucket_counts(v.document_baskets(spark, d), BUCKETS)


@query("pcy_frequent_items", _mined_sql("SELECT item, cnt FROM f_items"))
def pcy_frequent_items(spark, d):
    return first_pass(spark, d).items


@query("pcy_frequent_buckets", f"""WITH {V_BUCKETS} SELECT bucket, cnt FROM v_buckets
WHERE cnt >= (SELECT ceil(sum(cnt) * CAST({BUCKET_SHARE} AS DOUBLE)) FROM v_buckets)""")
def pcy_frequent_buckets(spark, d):
    counts = stage(it.bucket_counts(v.document_baskets(spark, d), BUCKETS), "bucket-counts")
    total = counts.agg(F.sum("cnt")).first()[0]
    return having_support(counts, it.min_support(total, BUCKET_SHARE))


@query("pcy_pair_counts", _mined_sql("SELECT a, b, cnt FROM c_pairs"))
def pcy_pair_counts(spark, d):
    return it.pair_counts(first_pass(spark, d).baskets)


@query("pcy_pair_counts_bucketed", f"""WITH {v.V_MINED}, v_hashed AS (
  SELECT unique_id, {RESIDUE.format('item')} AS h, item FROM v_items),
f_buckets AS (
  SELECT (x.h + y.h) % {BUCKETS} AS bucket FROM v_hashed x JOIN v_hashed y
  ON x.unique_id = y.unique_id AND x.item < y.item GROUP BY 1 HAVING count(*) >= (
    SELECT ceil(sum(k * (k - 1) / 2) * CAST({BUCKET_SHARE} AS DOUBLE)) FROM (SELECT count(*) AS k FROM v_items GROUP BY unique_id)))
SELECT a, b, cnt FROM c_pairs
WHERE ({RESIDUE.format('a')} + {RESIDUE.format('b')}) % {BUCKETS} IN (SELECT bucket FROM f_buckets)""")
def pcy_pair_counts_bucketed(spark, d):
    """The pair pass with the bucket filter switched on: pairs of other buckets are never made."""
    counts = stage(it.bucket_counts(v.document_baskets(spark, d), BUCKETS), "bucket-counts")
    total = counts.agg(F.sum("cnt")).first()[0]
    frequent = stage(having_support(counts, it.min_support(total, BUCKET_SHARE)), "frequent-buckets")
    return it.pair_counts(first_pass(spark, d).baskets, frequent, BUCKETS)


@query("pcy_frequent_pairs", _mined_sql("SELECT a, b, cnt FROM f_pairs"))
def pcy_frequent_pairs(spark, d):
    return contrast.second_pass(first_pass(spark, d), v.SUPPORT)


@query("pcy_triplet_counts", _mined_sql("SELECT a, b, c, cnt FROM c_triplets"))
def pcy_triplet_counts(spark, d):
    first = first_pass(spark, d)
    return contrast.triplet_counts(first, contrast.second_pass(first, v.SUPPORT)).drop("cnt_1", "cnt_0")


@query("pcy_frequent_triplets", _mined_sql("SELECT a, b, c, cnt FROM f_triplets"))
def pcy_frequent_triplets(spark, d):
    return mined(spark, d).triplets.select("a", "b", "c", "cnt")


_NAMED = f"""WITH {v.V_CONTRAST}, named AS (
  SELECT a || ' - ' || b || ' - ' || c AS triplet, cnt_1, cnt_0, cnt_1 - cnt_0 AS difference FROM f_triplets)"""
_TOP10 = "FROM named ORDER BY difference DESC, triplet LIMIT 10"


@query("triplet_class_counts", _contrast_sql("SELECT a, b, c, cnt_1, cnt_0 FROM f_triplets"))
def triplet_class_counts(spark, d):
    return balanced(spark, d).triplets.drop("cnt")


@query("triplet_contrast_top10", f"{_NAMED} SELECT triplet, cnt_1, cnt_0, difference {_TOP10}")
def triplet_contrast_top10(spark, d):
    return contrast.triplet_contrast(balanced(spark, d))


@query("chart_triplet_bars", f"{_NAMED} SELECT triplet, cnt_1, cnt_0 {_TOP10}")
def chart_triplet_bars(spark, d):
    return charts.triplet_bars(contrast.triplet_contrast(balanced(spark, d)))


@query("triplet_multihot", f"""WITH {v.V_MINED}, idx AS (
  SELECT a, b, c, row_number() OVER (ORDER BY a || ' - ' || b || ' - ' || c) - 1 AS idx FROM f_triplets)
SELECT unique_id, CAST(idx AS INTEGER) AS idx FROM v_triplets JOIN idx USING (a, b, c)""")
def triplet_multihot(spark, d):
    m = mined(spark, d)
    return ft.triplet_multihot(m.baskets, m.triplets)
