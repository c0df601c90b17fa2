"""Balancing, splits, folds, keys: exact sizes and the same rows for any partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import ranks
from corpusmill.operators import sampling as sm


def labelled(spark, zeros, ones):
    rows = [(i, 0) for i in range(zeros)] + [(zeros + i, 1) for i in range(ones)]
    return spark.createDataFrame(rows, "unique_id long, label int")


def sizes(df, column):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


@pytest.mark.parametrize("zeros,ones,each", [(2, 5, 2), (3, 3, 3), (40, 7, 7)])
def test_balance(spark, zeros, ones, each):
    assert sizes(sm.balance_undersample(labelled(spark, zeros, ones)), "label") == {0: each, 1: each}


def test_balance_without_one_class(spark):
    assert sm.balance_undersample(labelled(spark, 4, 0)).count() == 0


def test_downsample_zero(spark):
    assert sizes(sm.balance_downsample_zero(labelled(spark, 9, 4)), "label") == {0: 4, 1: 4}
    with pytest.raises(ValueError):
        sm.balance_downsample_zero(labelled(spark, 4, 9))


@pytest.mark.parametrize("n,train,val,test", [(10, 7, 1, 2), (7, 4, 1, 2), (1000, 700, 150, 150), (1, 0, 0, 1)])
def test_split_sizes(spark, n, train, val, test):
    df = labelled(spark, n, 0)
    got = sizes(sm.split_train_val_test(df), "split")
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == (train, val, test)
    two = sizes(sm.split_holdout(df), "split")
    assert (two.get("train", 0), two.get("test", 0)) == (train, n - train)


@pytest.mark.parametrize("n,train,val,test", [(922_182, 645_527, 138_327, 138_328), (2_000_025, 1_400_017, 300_004, 300_004)])
def test_published_split_sizes(spark, n, train, val, test):
    df = spark.range(n).withColumnRenamed("id", "unique_id")
    assert sizes(sm.split_train_val_test(df), "split") == {"train": train, "val": val, "test": test}


def test_fold_sizes(spark):
    folds = sm.stratified_kfold(labelled(spark, 103, 58))
    per_class = folds.groupBy("label", "fold").count().collect()
    assert sorted(r["count"] for r in per_class if r["label"] == 0) == [10] * 7 + [11] * 3
    assert sorted(r["count"] for r in per_class if r["label"] == 1) == [5] * 2 + [6] * 8
    few = sm.stratified_kfold(labelled(spark, 3, 2), folds=5)
    assert few.count() == 5 and max(r["count"] for r in few.groupBy("label", "fold").count().collect()) == 1


def test_same_rows_for_any_partitioning(spark):
    df = labelled(spark, 500, 130)
    seen = set()
    for parts in (1, 4, 64):
        p = df.repartition(parts)
        seen.add((
            tuple(sorted(map(tuple, sm.split_and_balance(p).collect()))),
            tuple(sorted(map(tuple, sm.stratified_kfold(p).collect()))),
            tuple(sorted(map(tuple, sm.shuffle_rows(p).collect()))),
        ))
    assert len(seen) == 1


@pytest.mark.parametrize("mode", ["train", "before", "both", "none"])
def test_split_modes(spark, mode):
    parts = sm.split_and_balance(labelled(spark, 300, 100), balance=mode)
    assert parts.count() == parts.select("unique_id").distinct().count()
    train = sizes(parts.where("split = 'train'"), "label")
    if mode in ("train", "both"):
        assert train[0] == train[1]
    if mode == "before":
        assert sizes(parts, "label") == {0: 100, 1: 100}
    if mode == "none":
        assert parts.count() == 400


def test_row_key(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") * 7).alias("k"), (F.col("id") % 2).alias("lead"))
    rows = ranks.assign_row_key(df.repartition(13), "k", "key", lead=["lead"], buckets=32).collect()
    ordered = sorted(rows, key=lambda r: (r["lead"], r["k"]))
    assert [r["key"] for r in ordered] == list(range(5000))


def test_running_sums_descending(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("s"), (F.col("id") % 3).alias("v"))
    rows = ranks.running_sums(df, "s", {"total": F.col("v")}, descending=True, buckets=16).collect()
    total = 0
    for r in sorted(rows, key=lambda r: -r["s"]):
        total += r["v"]
        assert r["total"] == total
