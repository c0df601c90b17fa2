"""Both sides of every size bound give the same rows, and nothing is dropped without an error."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.stopwords import ENGLISH
from corpusmill.operators import clean, dedup, features, itemsets, joins, metrics, ranks, sampling
from corpusmill.operators.aggregates import crosstab, vector_mean
from corpusmill.sources.delimited import read_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_frequent_items_as_constant_or_joined(spark):
    baskets = spark.createDataFrame(
        [(1, 1, ["a", "b", "z"]), (2, 1, ["z"]), (3, 0, []), (4, 0, ["a", "b"])], "unique_id long, label int, items array<string>")
    frequent = spark.createDataFrame([("a",), ("b",)], "item string")
    constant = rows(itemsets.keep_frequent(baskets, frequent))
    assert constant == rows(itemsets.keep_frequent(baskets, frequent, max_constant=1))
    assert [r[2] for r in constant] == [["a", "b"], [], [], ["a", "b"]]
    with pytest.raises(ValueError):
        itemsets.keep_frequent(baskets.drop("unique_id"), frequent)


def test_bucket_filter_before_the_count(spark):
    baskets = spark.createDataFrame([(i, ["a", "b", "c", "d"][: 2 + i % 3]) for i in range(9)], "unique_id long, items array<string>")
    counts = itemsets.pair_counts(baskets).withColumn("bucket", itemsets.pair_bucket("a", "b", 5))
    some = counts.select("bucket").distinct().orderBy("bucket").limit(2)
    expected = rows(counts.join(some, "bucket", "left_semi").drop("bucket"))
    assert expected and rows(itemsets.pair_counts(baskets, some, 5)) == expected


def test_lookup_without_a_mapping_fails(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 7)], "id int, cluster int")
    mapping = spark.createDataFrame([(0, 5), (1, 6)], "cluster int, prediction int")
    assert rows(joins.lookup_map(df.where("id < 3"), mapping, "cluster")) == [(0, 1, 5), (1, 2, 6)]
    with pytest.raises(Exception, match="no mapping for 7"):
        joins.lookup_map(df, mapping, "cluster").collect()


def test_confusion_matrix_has_all_classes(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 0)], "label int, prediction int")
    assert rows(metrics.confusion_matrix(df)) == [(0, 1, 0, 0), (1, 0, 0, 1), (2, 1, 0, 1)]
    with pytest.raises(ValueError):
        metrics.confusion_matrix(df, classes=(0, 1))
    with pytest.raises(Exception, match="not a listed value"):
        crosstab(df, "label", "prediction").collect()


def test_folds_need_labels(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "unique_id long, label int")
    with pytest.raises(ValueError):
        sampling.stratified_kfold(df, folds=2)


def test_one_lemma_per_word_in_the_row_or_joined(spark):
    lexicon = spark.createDataFrame([("leaves", "NNS"), ("leaves", "VBZ"), ("runs", "VBZ")], "token string, tag string")
    lemmas = spark.createDataFrame(
        [("leaves", "n", "leaf"), ("leaves", "v", "leave"), ("runs", "v", "run"), ("cats", "n", "cat")], "token string, class string, lemma string")
    texts = spark.createDataFrame(
        [(1, ["leaves", "fall", "leaves"]), (2, ["runs", "cats"]), (3, []), (4, None)], "unique_id long, tokens array<string>")
    near = clean.lemma_lookup(texts, "tokens", lexicon, lemmas)
    far = clean.lemma_lookup(texts, "tokens", lexicon, lemmas, dictionary_bytes=0)
    assert rows(near) == rows(far) == [(1, ["leaf", "fall", "leaf"]), (2, ["run", "cat"]), (3, []), (4, None)]
    assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()


def test_term_weights_in_the_row_or_joined(spark):
    texts = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, []), (4, None)], "unique_id long, tokens array<string>")
    model = features.tfidf_fit(texts.where("tokens is not null"), min_df=0.3, max_n=2)
    rounded = [[(a, t, round(w, 9)) for a, t, w in rows(model.transform_long(texts, most=n))] for n in (1000, 1)]
    assert rounded[0] and rounded[0] == rounded[1]


def test_word_means_do_not_depend_on_parts(spark):
    texts = spark.createDataFrame([(i, ["the", f"w{i % 3}"]) for i in range(30)], "unique_id long, tokens array<string>")
    vectors = spark.createDataFrame([("the", [1.0, 0.0]), ("w1", [0.0, 4.0])], "word string, vector array<double>")
    found = {r["unique_id"]: r["embedding"] for r in vector_mean(texts, "tokens", vectors, 2).collect()}
    assert found == {i: [0.5, 2.0] if i % 3 == 1 else [1.0, 0.0] for i in range(30)}


def test_row_keys_with_two_texts_fail(spark):
    good = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "row_id long, body string")
    assert dedup.checked_keys(good, "body", "row_id") is good
    for bad in ([(1, "a"), (1, "b")], [(1, "a"), (1, None)], [(None, "a")]):
        with pytest.raises(ValueError):
            dedup.checked_keys(spark.createDataFrame(bad, "row_id long, body string"), "body", "row_id")


def test_header_in_another_order_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    schema = spark.createDataFrame([], "a string, b string").schema
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert len(ENGLISH) == len(set(ENGLISH)) == 181


def test_large_texts_are_split_when_lines_are_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "x,y\n" * 200_000)
    schema = spark.createDataFrame([], "a string, b string").schema
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        one, many = (read_csv(spark, str(tmp_path / "t.csv"), schema, multi_line=m) for m in (True, False))
        assert one.count() == many.count() == 200_000
        assert many.select("a").rdd.getNumPartitions() > one.select("a").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_ranks_with_one_long_beginning(spark):
    keys = spark.range(60_000).select(F.concat(F.lit("always the same item, "), F.md5(F.col("id").cast("string"))).alias("k"))
    ranked = {r["k"]: r["n"] for r in ranks.text_rank(keys, "k", "n").collect()}
    assert ranked == {k: i + 1 for i, k in enumerate(sorted(ranked))} and len(ranked) == 60_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranks.text_bucket(keys, "k").groupBy("_bucket").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 60_000 / 8
    assert ranks.text_rank(keys.limit(0), "k", "n").collect() == []
