"""The tables behind the charts; drawing them is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.aggregates import crosstab, value_counts
from corpusmill.operators.features import pca_2d


def posts_per_category(df: DataFrame, category: str) -> DataFrame:
    return value_counts(df, category)


def triplet_bars(contrast: DataFrame) -> DataFrame:
    return contrast.select("triplet", "cnt_1", "cnt_0")


def cluster_scatter(df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Two components and the cluster of each row, and a row of mean position per cluster."""
    points = pca_2d(df, features).select("pc1", "pc2", cluster, F.lit(False).alias("is_center"))
    centers = points.groupBy(cluster).agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"))
    return points.unionByName(centers.withColumn("is_center", F.lit(True)))


def cluster_distribution(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return crosstab(df, cluster, label)


def holdout_curve(results: DataFrame) -> DataFrame:
    return results.where(F.col("metric") == "accuracy").select("param", F.col("value").alias("accuracy"))


def elbow(results: DataFrame) -> DataFrame:
    return results.where(F.col("metric") == "cost").select("param", F.col("value").alias("cost"))
