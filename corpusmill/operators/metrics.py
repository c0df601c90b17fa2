"""Metrics from one table of (label, prediction[, score])."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.ranks import range_bucket, running_sums
from corpusmill.sources.staging import stage


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 when the divisor is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: share of equal labels."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def precision_recall(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: int = 1
) -> DataFrame:
    """One row: precision and recall of the positive class."""
    actual, predicted = F.col(label) == positive, F.col(prediction) == positive
    hits = F.count_if(actual & predicted)
    return df.agg(
        _ratio(hits, F.count_if(predicted)).alias("precision"), _ratio(hits, F.count_if(actual)).alias("recall")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class; all cells are present.

    Without ``classes`` they are all labels and predictions that occur, besides 0 and 1. With it, another value fails the
    job. Rows without a label or a prediction are in no cell.
    """
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")).dropna(subset=[label, prediction])
    rows = cells.collect()  # one row per pair of classes
    found = {r[label] for r in rows} | {r[prediction] for r in rows}
    if classes is not None and found - set(classes):
        raise ValueError(f"not listed as a class: {sorted(found - set(classes))}")
    classes = sorted(found | {0, 1}) if classes is None else classes
    of = {(r[label], r[prediction]): r["n"] for r in rows}
    type_name = df.schema[label].dataType.simpleString()
    columns = ", ".join(f"`pred_{c}` long" for c in classes)
    table = [(a, *[of.get((a, b), 0) for b in classes]) for a in classes]
    return df.sparkSession.createDataFrame(table, f"`{label}` {type_name}, {columns}")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy and the two averages."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    # From here on the table has a few cells only.
    sides = F.explode(F.array(
        F.struct(F.col(label).cast("int").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named")),
        F.struct(F.col(prediction).cast("int").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named")),
    )).alias("s")
    hit = F.when((F.col(label) == F.col(prediction)) & (F.col("s.support") > 0), F.col("n")).otherwise(0)
    per_class = cells.select("*", sides).select("s.*", hit.alias("hit")).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("hit").alias("hit")
    )
    precision, recall = _ratio(F.col("hit"), F.col("named")), _ratio(F.col("hit"), F.col("support"))
    scored = per_class.select("class", precision.alias("precision"), recall.alias("recall"), "support", "hit")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    scored = scored.withColumn("f1", f1)
    columns = ["class", "precision", "recall", "f1", "support"]
    total = F.sum("support")
    measures = ("precision", "recall", "f1")
    summary = scored.agg(
        total.alias("support"),
        _ratio(F.sum("hit"), total).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}") for m in measures],
    )

    def row(name: str, prefix: str | None) -> Column:
        values = [F.col("accuracy") if prefix is None else F.col(f"{prefix}_{m}") for m in measures]
        return F.struct(F.lit(name).alias("class"), *[v.alias(m) for v, m in zip(values, measures)], F.col("support"))

    averages = summary.select(
        F.inline(F.array(row("accuracy", None), row("macro avg", "macro"), row("weighted avg", "weighted")))
    )
    return scored.withColumn("class", F.col("class").cast("string")).select(columns).unionByName(averages)


def roc_points(
    df: DataFrame, label: str = "label", score: str = "score", positive: int = 1, buckets: int | None = None
) -> DataFrame:
    """(threshold, p, n, tp, fp), one row per distinct score, falling.

    Equal scores are merged first, so a score shared by many rows is one row here; the running
    sums are taken in two phases and not in one task.
    """
    is_positive = F.col(label) == positive
    counts = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(is_positive).alias("p"), F.count_if(~is_positive).alias("n")
    )
    return running_sums(counts, "threshold", {"tp": F.col("p"), "fp": F.col("n")}, descending=True, buckets=buckets)


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score", positive: int = 1, buckets: int | None = None, corners: bool = False
) -> DataFrame:
    """(fpr, tpr, threshold), with the start point (0, 0) at an infinite threshold.

    With ``corners`` the points between two equal steps are left out: they lie on a straight line. The first point after
    the start and the last one stay.
    """
    is_positive = F.col(label) == positive
    totals = df.agg(F.count_if(is_positive).alias("p"), F.count_if(~is_positive).alias("n")).first()
    points = roc_points(df, label, score, positive, buckets)
    points = (_corners(points, buckets) if corners else points).select(
        _ratio(F.col("fp"), F.lit(totals["n"])).alias("fpr"), _ratio(F.col("tp"), F.lit(totals["p"])).alias("tpr"),
        "threshold",
    )
    start = df.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return start.unionByName(points)


def _corners(points: DataFrame, buckets: int | None) -> DataFrame:
    """Points whose step differs from the next one, and the first and last; neighbours across range buckets are handed on."""
    points = stage(points, "roc-points")
    bucketed = range_bucket(points, "threshold", buckets)
    step = F.struct("p", "n")
    own = Window.partitionBy("_bucket").orderBy(F.desc("threshold"))
    rows = bucketed.withColumns({"_next": F.lead(step).over(own), "_step": step})
    # One row per bucket: the step of its highest point, which is the next one of the bucket above it.
    firsts = bucketed.groupBy("_bucket").agg(F.max_by(step, "threshold").alias("_first"), F.max("threshold").alias("_top"))
    across = Window.orderBy(F.desc("_top"))
    handed = firsts.select("_bucket", F.lead("_first").over(across).alias("_after"), (F.row_number().over(across) == 1).alias("_leads"), "_top")
    rows = rows.join(F.broadcast(handed), "_bucket")
    following = F.coalesce("_next", "_after")
    first = F.col("_leads") & (F.col("threshold") == F.col("_top"))
    return rows.where(first | following.isNull() | (following != F.col("_step"))).select(points.columns)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", **options) -> DataFrame:
    """One row: area under the curve by trapezoids."""
    points = roc_points(df, label, score, **options)
    # Width n, mean height (tp + tp before) / 2, where the value before is tp - p.
    area = F.sum(F.col("n") * (2.0 * F.col("tp") - F.col("p")) / 2.0)
    return points.agg(F.try_divide(area, F.sum("p").cast("double") * F.sum("n")).alias("auc"))
