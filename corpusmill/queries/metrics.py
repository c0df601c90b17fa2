"""Metrics over the vector table's stand-in score and prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import metrics as mt
from corpusmill.queries import views as v
from corpusmill.queries.registry import query


def _rounded(df, columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("metric_accuracy", f"""WITH {v.V_VEC}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM v_vec""")
def metric_accuracy(spark, d):
    return _rounded(mt.accuracy(v.vectors(spark, d)), ["accuracy"])


@query("metric_precision_recall", f"""WITH {v.V_VEC}
SELECT round(coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1), 0), 0), 6) AS precision,
       round(coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (label = 1), 0), 0), 6) AS recall
FROM v_vec""")
def metric_precision_recall(spark, d):
    return _rounded(mt.precision_recall(v.vectors(spark, d)), ["precision", "recall"])


@query("classification_report", f"""WITH {v.V_VEC}, k AS (SELECT unnest([0, 1]) AS class), c AS (
  SELECT class, count(*) FILTER (label = class) AS support,
         coalesce(count(*) FILTER (label = class AND prediction = class) / nullif(count(*) FILTER (prediction = class), 0), 0) AS p,
         coalesce(count(*) FILTER (label = class AND prediction = class) / nullif(count(*) FILTER (label = class), 0), 0) AS r
  FROM v_vec, k GROUP BY class),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM c),
acc AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a, count(*) AS n FROM v_vec),
rows AS (
  SELECT CAST(class AS VARCHAR) AS class, p AS precision, r AS recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', a, a, a, n FROM acc
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rows""")
def classification_report(spark, d):
    return _rounded(mt.classification_report(v.vectors(spark, d)), ["precision", "recall", "f1"])


@query("confusion_matrix", f"""WITH {v.V_VEC} SELECT label, count(*) FILTER (prediction = 0) AS pred_0,
count(*) FILTER (prediction = 1) AS pred_1 FROM v_vec GROUP BY label""")
def confusion_matrix(spark, d):
    return mt.confusion_matrix(v.vectors(spark, d))


V_ROC = f"""{v.V_VEC}, s AS (
  SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM v_vec GROUP BY score),
roc AS (
  SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp,
         sum(p) OVER () AS all_p, sum(n) OVER () AS all_n,
         row_number() OVER (ORDER BY score DESC) AS place, lead(p) OVER (ORDER BY score DESC) AS next_p,
         lead(n) OVER (ORDER BY score DESC) AS next_n FROM s)"""
ROC_SQL = f"""WITH {V_ROC} SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT round(fp / all_n, 6), round(tp / all_p, 6) FROM roc
WHERE place = 1 OR next_p IS NULL OR next_p <> p OR next_n <> n"""


@query("roc_curve", ROC_SQL)
def roc_curve(spark, d):
    return _rounded(mt.roc_curve(v.vectors(spark, d), corners=True).drop("threshold"), ["fpr", "tpr"])


@query("roc_auc", f"WITH {V_ROC} SELECT round(sum(n * (2.0 * tp - p) / 2.0) / (max(all_p) * max(all_n)), 6) AS auc FROM roc")
def roc_auc(spark, d):
    return _rounded(mt.roc_auc(v.vectors(spark, d)), ["auc"])


@query("chart_roc", ROC_SQL)
def chart_roc(spark, d):
    return _rounded(mt.roc_curve(v.vectors(spark, d), corners=True).select("fpr", "tpr"), ["fpr", "tpr"])
