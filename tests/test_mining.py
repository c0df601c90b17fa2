"""Frequent itemsets against hand-made answers and brute force."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusmill.operators import features as ft
from corpusmill.operators import itemsets as it
from corpusmill.operators import vertical
from corpusmill.operators.aggregates import having_support
from corpusmill.operators.joins import merge_two_counts
from corpusmill.plans import contrast
from corpusmill.sources.staging import stage

BASKETS = [(1, 1, "abc"), (2, 1, "abc"), (3, 0, "ab"), (4, 1, "ac"), (5, 0, "bcd"), (6, 0, "abcd")]
SCHEMA = "unique_id long, label int, items array<string>"


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(i, y, list(s)) for i, y, s in BASKETS], SCHEMA)


@pytest.fixture(scope="module")
def random_baskets(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i:02d}" for i in range(30)]
    rows = [
        (i, int(rng.integers(2)), sorted(w for j, w in enumerate(words) if rng.random() < 0.9 / (1 + j / 4)))
        for i in range(200)
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def _brute(rows, size):
    counts = {}
    for _, _, items in rows:
        for c in combinations(items, size):
            counts[c] = counts.get(c, 0) + 1
    return counts


def test_small_counts(small):
    mined = contrast.mine(small, 3, 3, 3)
    assert {r["item"]: r["cnt"] for r in mined.items.collect()} == {"a": 5, "b": 5, "c": 5}
    assert {(r["a"] + r["b"]): r["cnt"] for r in mined.pairs.collect()} == {"ab": 4, "ac": 4, "bc": 4}
    assert [tuple(r) for r in mined.triplets.collect()] == [("a", "b", "c", 3, 2, 1)]
    top = contrast.triplet_contrast(mined).collect()
    assert [tuple(r) for r in top] == [("a - b - c", 2, 1, 1)]
    hot = {r["unique_id"]: r["idx"] for r in ft.triplet_multihot(small, mined.triplets).collect()}
    assert hot == {1: 0, 2: 0, 6: 0}
    vectors = ft.triplet_vectors(small, mined.triplets).select("unique_id", vector_to_array("features").alias("f"))
    assert {r["unique_id"]: r["f"] for r in vectors.collect()} == {i: [float(i in (1, 2, 6))] for i in range(1, 7)}


def test_nothing_frequent(small):
    mined = contrast.mine(small, 5, 5, 5)
    assert mined.items.count() == 3
    assert mined.pairs.count() == 0 and mined.triplets.count() == 0
    assert contrast.triplet_contrast(mined).count() == 0


def test_support_as_share():
    assert it.min_support(399, 0.10) == 40
    assert it.min_support(10, 3) == 3


@pytest.mark.parametrize("parts", [1, 7])
def test_mining_equals_brute_force(random_baskets, parts):
    rows, df = random_baskets
    mined = contrast.mine(df.repartition(parts), 20, 25, 30)
    pairs = {k: c for k, c in _brute(rows, 2).items() if c >= 25}
    assert {(r["a"], r["b"]): r["cnt"] for r in mined.pairs.collect()} == pairs
    triplets = {
        k: c for k, c in _brute(rows, 3).items() if c >= 30 and all(p in pairs for p in combinations(k, 2))
    }
    assert {(r["a"], r["b"], r["c"]): r["cnt"] for r in mined.triplets.collect()} == triplets
    split = {k: [0, 0] for k in triplets}
    for _, y, items in rows:
        for k in combinations(items, 3):
            if k in split:
                split[k][y] += 1
    counts = it.class_counts(it.triplet_matches(df, mined.triplets)).collect()
    assert {(r["a"], r["b"], r["c"]): [r["cnt_0"], r["cnt_1"]] for r in counts} == split


def test_fpgrowth_agrees(random_baskets):
    rows, df = random_baskets
    mined = contrast.mine(df, 40, 40, 40)
    model = FPGrowth(itemsCol="items", minSupport=40 / len(rows)).fit(df)
    sizes = {r["n"]: r["count"] for r in model.freqItemsets.groupBy(F.size("items").alias("n")).count().collect()}
    assert (mined.items.count(), mined.pairs.count(), mined.triplets.count()) == (sizes[1], sizes[2], sizes[3])


def test_long_item_list_is_joined(random_baskets):
    _, df = random_baskets
    frequent = stage(having_support(it.item_counts(df), 30), "items")
    constant = it.keep_frequent(df, frequent).where(F.size("items") > 0)
    joined = it.keep_frequent(df, frequent, max_constant=0)
    assert sorted(map(str, joined.select(df.columns).collect())) == sorted(map(str, constant.collect()))


@pytest.mark.parametrize("buckets", [7, 1000])
def test_bucket_counts_equal_brute_force(spark, random_baskets, buckets):
    rows, df = random_baskets
    hashes = {
        r["item"]: r["h"]
        for r in it.item_counts(df).select("item", it.item_residue(F.col("item"), buckets).alias("h")).collect()
    }
    want = {}
    for (a, b), c in _brute(rows, 2).items():
        bucket = (hashes[a] + hashes[b]) % buckets
        want[bucket] = want.get(bucket, 0) + c
    got = {r["bucket"]: r["cnt"] for r in it.bucket_counts(df, buckets).collect()}
    assert got == want
    checked = spark.createDataFrame([("w00", "w01")], "a string, b string").select(it.pair_bucket("a", "b", buckets))
    assert checked.first()[0] == (hashes["w00"] + hashes["w01"]) % buckets


def test_bucket_counts_of_a_very_long_basket(spark):
    n = 20_000
    items = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("x"), i.cast("string")))
    df = spark.range(2).select(F.col("id").alias("unique_id"), F.when(F.col("id") == 0, items).alias("items"))
    assert it.bucket_counts(df).agg(F.sum("cnt")).first()[0] == n * (n - 1) // 2


def test_bucket_filter_changes_nothing_below_pair_support(random_baskets):
    _, df = random_baskets
    mined = contrast.mine(df, 20, 25, 30)
    frequent = having_support(it.bucket_counts(df, 50), 25)
    filtered = having_support(it.pair_counts(mined.baskets, frequent, 50), 25)
    assert sorted(map(tuple, filtered.collect())) == sorted(map(tuple, mined.pairs.select("a", "b", "cnt").collect()))


def test_merge_two_counts(spark):
    one = spark.createDataFrame([("x", 2), ("y", 1)], "triplet string, cnt long")
    zero = spark.createDataFrame([("y", 5), ("z", 3)], "triplet string, cnt long")
    assert sorted(map(tuple, merge_two_counts(one, zero).collect())) == [("x", 2, 0), ("y", 1, 5), ("z", 0, 3)]


@pytest.mark.parametrize(("size", "block", "held", "bits"), [(4096, 1024, 2_000_000, 1 << 27), (16, 7, 40, 1), (1, 1, 1, 4000)])
def test_bit_sets_count_as_brute_force_does(spark, random_baskets, monkeypatch, size, block, held, bits):
    for name, value in (("SLICE", size), ("BLOCK", block), ("HELD_PAIRS", held), ("BITS", bits)):
        monkeypatch.setattr(vertical, name, value)
    rows, df = random_baskets
    odd = spark.createDataFrame([(900, None, ["w00", "w01", "w02"]), (901, 1, None), (902, 0, []), (903, 5, ["z", "é"])], SCHEMA)
    rows = [*rows, (900, None, ["w00", "w01", "w02"]), (903, 5, ["z", "é"])]
    both = df.unionByName(odd).repartition(3)
    pairs = _brute(rows, 2)
    assert {(r["a"], r["b"]): r["cnt"] for r in it.pair_counts(both).collect()} == pairs
    frequent = stage(having_support(it.pair_counts(both), 25), "pairs")
    known = {k for k, c in pairs.items() if c >= 25}
    want = {k: [c, 0, 0] for k, c in _brute(rows, 3).items() if known.issuperset(combinations(k, 2))}
    for _, y, items in rows:
        for k in combinations(items, 3):
            if k in want and y in (0, 1):
                want[k][2 - y] += 1
    found = it.triplet_class_counts(both, frequent).collect()
    assert {(r["a"], r["b"], r["c"]): [r["cnt"], r["cnt_1"], r["cnt_0"]] for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("bound", ["MAX_PAIRS", "MAX_TRIPLETS"])
def test_triplets_that_cannot_be_sent_are_counted_row_by_row(random_baskets, monkeypatch, bound):
    _, df = random_baskets
    frequent = stage(having_support(it.pair_counts(df), 25), "pairs")
    for label in ("label", None):
        want = sorted(map(tuple, it.triplet_class_counts(df, frequent, label).collect()))
        with monkeypatch.context() as m:
            m.setattr(vertical, bound, 3)
            assert vertical.partners(frequent) is None
            assert sorted(map(tuple, it.triplet_class_counts(df, frequent, label).collect())) == want


def test_counting_makes_no_row_of_a_pair_or_triplet(random_baskets):
    _, df = random_baskets
    frequent = stage(having_support(it.pair_counts(df), 25), "pairs")
    for counted in (it.pair_counts(df), it.triplet_counts(df, frequent)):
        assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
