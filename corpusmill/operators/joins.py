"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.staging import stage


def join_left_key(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Left equi-join on a key, with only the named columns of the right side."""
    right = right.select(key, *columns) if columns else right
    return left.join(right, key, "left")


def join_features_labels(features: DataFrame, labels: DataFrame, key: str = "unique_id") -> DataFrame:
    """Attach labels to vectors by key; a key that misses its partner fails the job."""
    both = features.withColumn("_f", F.lit(True)).join(labels.withColumn("_l", F.lit(True)), key, "full")
    complete = F.col("_f").isNotNull() & F.col("_l").isNotNull()
    failure = F.raise_error(F.concat(F.lit("key without partner: "), F.col(key).cast("string")))
    return both.withColumn(key, F.when(complete, F.col(key)).otherwise(failure)).drop("_f", "_l")


def semi_join_frequent(df: DataFrame, frequent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in a set of frequent ones. Give it a stage table: Spark then knows whether it is small."""
    return df.join(frequent.select(*on), list(on), "left_semi")


def merge_two_counts(
    ones: DataFrame, zeros: DataFrame, key: str = "triplet", count: str = "cnt"
) -> DataFrame:
    """Two counters side by side, 0 where a key is missing: (key, cnt_1, cnt_0)."""
    none = F.lit(0).cast("long")
    long = ones.select(key, F.col(count).alias("cnt_1"), none.alias("cnt_0")).unionByName(
        zeros.select(key, none.alias("cnt_1"), F.col(count).alias("cnt_0"))
    )
    return long.groupBy(key).agg(F.sum("cnt_1").alias("cnt_1"), F.sum("cnt_0").alias("cnt_0"))


def lookup_map(df: DataFrame, mapping: DataFrame, on: str) -> DataFrame:
    """Attach the columns of a mapping such as cluster to label; a value that is not in it fails the job.

    The mapping becomes a stage table, so that Spark knows its size and sends a small one to the rows.
    """
    joined = df.join(stage(mapping.withColumn("_mapped", F.lit(True)), "mapping"), on, "left")
    failure = F.raise_error(F.concat(F.lit("no mapping for "), F.coalesce(F.col(on).cast("string"), F.lit("NULL"))))
    found = {c: F.when(F.col("_mapped"), F.col(c)).otherwise(failure) for c in mapping.columns if c != on}
    return joined.withColumns(found).drop("_mapped")


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two arrays."""
    difference = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(difference, F.lit(0.0), lambda total, d: total + d)


def nearest_to_center(
    points: DataFrame, centers: Sequence[Sequence[float]], id_col: str = "unique_id", vector: str = "embedding"
) -> DataFrame:
    """(cluster, id, distance): the point nearest to each center; ties go to the smaller id.

    The centers are the few that a fitted model has, in the order of their cluster numbers. Each
    is one aggregate of a single scan, so no pair of point and center is ever a row.
    """
    best = []
    for i, center in enumerate(centers):
        constant = F.array(*[F.lit(float(x)) for x in center])
        candidate = F.struct(squared_distance(vector, constant).alias("d2"), F.col(id_col).alias(id_col))
        best.append(F.min(candidate).alias(f"c{i}"))
    one_row = points.agg(*best)
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("cluster"), F.col(f"c{i}").alias("nearest")) for i in range(len(centers))
    ])).alias("r")
    return one_row.select(rows).select(
        "r.cluster", F.col(f"r.nearest.{id_col}").alias(id_col), F.sqrt("r.nearest.d2").alias("distance")
    )
