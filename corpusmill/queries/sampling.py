"""Balancing, splitting and folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import sampling as sm
from corpusmill.queries import views as v
from corpusmill.queries.registry import query

ORDER = v.hash_order_sql()


def _columns(spark, d):
    return v.labelled(spark, d).select("unique_id", "label", "label2")


def balanced_sql(source: str, name: str, label: str = "label") -> str:
    """CTE ``name``: both classes cut to the size of the smaller one."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {ORDER}) AS in_class FROM {source}),
{name} AS (
  SELECT * EXCLUDE (in_class) FROM {name}_r WHERE in_class <= (
    SELECT least(count(*) FILTER ({label} = 0), count(*) FILTER ({label} = 1)) FROM {source}))"""


def three_way_sql(source: str, name: str) -> str:
    """CTE ``name``: 70/15/15 split."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (ORDER BY {ORDER}) AS rn, count(*) OVER () AS n FROM {source}),
{name}_s AS (SELECT *, ceil(CAST(0.3 AS DOUBLE) * n) AS rest FROM {name}_r),
{name} AS (
  SELECT * EXCLUDE (rn, n, rest), CASE WHEN rn <= n - rest THEN 'train' WHEN rn <= n - ceil(rest * 0.5) THEN 'val'
                                  ELSE 'test' END AS split FROM {name}_s)"""


V = f"v_labelled AS (SELECT unique_id, label, label2 FROM (WITH {v.V_LABELLED} SELECT * FROM v_labelled))"


@query("balance_undersample", f"WITH {V}, {balanced_sql('v_labelled', 'b')} SELECT unique_id, label FROM b")
def balance_undersample(spark, d):
    return sm.balance_undersample(_columns(spark, d)).select("unique_id", "label")


@query("balance_downsample_zero", f"WITH {V}, {balanced_sql('v_labelled', 'b', 'label2')} SELECT unique_id, label2 FROM b")
def balance_downsample_zero(spark, d):
    return sm.balance_downsample_zero(_columns(spark, d), label="label2").select("unique_id", "label2")


@query("shuffle_rows", f"WITH {V} SELECT unique_id, row_number() OVER (ORDER BY {ORDER}) AS position FROM v_labelled")
def shuffle_rows(spark, d):
    return sm.shuffle_rows(_columns(spark, d).select("unique_id"))


@query("split_holdout", f"WITH {V}, {v.split_sql('v_labelled')} SELECT unique_id, label, split FROM v_split")
def split_holdout(spark, d):
    return sm.split_holdout(_columns(spark, d)).select("unique_id", "label", "split")


@query("split_train_val_test", f"WITH {V}, {three_way_sql('v_labelled', 's')} SELECT unique_id, label, split FROM s")
def split_train_val_test(spark, d):
    return sm.split_train_val_test(_columns(spark, d)).select("unique_id", "label", "split")


_THEN_BALANCE = f"""WITH {V}, {three_way_sql('v_labelled', 's')}, train AS (SELECT * FROM s WHERE split = 'train'),
{balanced_sql('train', 'bt')}
SELECT unique_id, label, split FROM bt UNION ALL SELECT unique_id, label, split FROM s WHERE split <> 'train'"""


@query("split_then_balance", _THEN_BALANCE)
def split_then_balance(spark, d):
    return sm.split_and_balance(_columns(spark, d), balance="train").select("unique_id", "label", "split")


@query("balance_then_split", f"""WITH {V}, {balanced_sql('v_labelled', 'b')}, {three_way_sql('b', 's')}
SELECT unique_id, label, split FROM s""")
def balance_then_split(spark, d):
    return sm.split_and_balance(_columns(spark, d), balance="before").select("unique_id", "label", "split")


@query("stratified_kfold", f"""WITH {V}, r AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {ORDER}) AS rn, count(*) OVER (PARTITION BY label) AS n
  FROM v_labelled)
SELECT unique_id, label, CAST((SELECT count(*) FROM range(1, 10) f(k) WHERE r.rn > (r.n * f.k) // 10) AS INTEGER) AS fold
FROM r""")
def stratified_kfold(spark, d):
    return sm.stratified_kfold(_columns(spark, d)).select("unique_id", "label", "fold")


@query("union_train_val", f"WITH {V}, {three_way_sql('v_labelled', 's')} SELECT unique_id, label FROM s WHERE split IN ('train', 'val')")
def union_train_val(spark, d):
    parts = sm.split_train_val_test(_columns(spark, d))
    return sm.union_train_val(parts).select("unique_id", F.col("label"))
