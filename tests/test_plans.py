"""Physical plans: no product of tables, no whole rows in one task, columns pruned at the scan."""

from __future__ import annotations

from pathlib import Path

import pytest
from __spark_entry__ import queries
from pyspark.sql import functions as F

from corpusmill.operators import dedup, ranks, sampling

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

NAMES = [
    "assign_row_key", "balance_undersample", "cluster_label_nearest", "clean_corpus", "contains_itemset",
    "dedup_length_aware", "duplicate_flag", "lookup_map", "nearest_to_center", "pcy_bucket_counts", "pcy_triplet_counts",
    "roc_auc", "roc_curve", "shuffle_rows", "split_holdout", "stratified_kfold", "tfidf_transform", "vector_mean",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_product_of_tables(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_split_and_fold_do_not_shuffle_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("label", (F.col("doc_id") % 2).cast("int"))
    for out in (
        sampling.split_train_val_test(docs, "doc_id"), sampling.balance_undersample(docs, "doc_id"),
        sampling.stratified_kfold(docs, "doc_id"),
    ):
        assert "Exchange" not in plan_of(out)


def test_row_key_shuffles_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        plan = plan_of(ranks.assign_row_key(docs, "doc_id"))
        lines = plan.splitlines()
        wide = [i for i, line in enumerate(lines) if "Exchange" in line and "text" in "".join(lines[i:i + 2])]
        assert len(wide) <= 1 and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_shuffles_wide_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
            F.col("doc_id").alias("row_id"), F.col("text").alias("body"), "source")
        plan = plan_of(dedup.dedup_length_aware(docs))
        # The final distinct reuses the partitioning of the join by row key.
        assert "Exchange hashpartitioning(row_id" in plan
        assert "Exchange hashpartitioning(body" not in plan and "body#" not in " ".join(
            line for line in plan.splitlines() if "Exchange" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(queries()["word_count"](spark, SF_DIR))
    assert "lang" not in plan and "n_chars" not in plan
