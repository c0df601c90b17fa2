"""Word vectors: the tree from a histogram, parts, and means against brute force."""

from __future__ import annotations

import heapq
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import clean, clusters, features, parts
from corpusmill.operators import wordvectors as wv
from corpusmill.operators.aggregates import vector_mean
from corpusmill.operators.wordvectors import WordVectors


def test_grouped_tree_costs_what_the_plain_one_costs():
    random.seed(1)
    for _ in range(100):
        counts = sorted(random.randint(2, 20) for _ in range(random.randint(1, 60)))
        groups = sorted(Counter(counts).items())
        tree = wv.huffman([c for c, _ in groups], [n for _, n in groups])
        above, sides = wv.tree_paths(tree, np.arange(len(counts)))
        cost = int(((above >= 0).sum(1) * np.array(counts)).sum())
        heap, best = list(counts), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            best += both
            heapq.heappush(heap, both)
        assert cost == best
        codes = {tuple((int(a), int(s)) for a, s in zip(above[i], sides[i]) if a >= 0) for i in range(len(counts))}
        assert len(codes) == len(counts)


def test_repeated_words_stay_finite():
    groups = [(2, 3), (20000, 1)]
    tree = wv.huffman([c for c, _ in groups], [n for _, n in groups])
    up, side = wv.tree_paths(tree, np.arange(4))
    above = np.unique(up[up >= 0])
    vectors, inner = wv.first_vectors(np.arange(4), 10, 1), np.zeros((len(above) + 1, 10), np.float32)
    words = np.r_[np.full(20000, 3), 0, 1, 2]
    rows, sides = np.where(up >= 0, np.searchsorted(above, up), len(above)), np.where(up >= 0, side, 0.5)
    trained = wv.skip_gram(words, np.arange(len(words)) // 1000, rows, sides, vectors, inner, 5, lambda d: 0.025, np.random.default_rng(1))
    assert trained.all() and np.isfinite(vectors).all() and np.abs(vectors).max() < 50


@pytest.mark.parametrize(("partitions", "iterations"), [(1, 1), (3, 2)])
def test_the_model_is_a_table(spark, partitions, iterations):
    rows = [(i, (["cat", "dog", "pet"] if i % 2 else ["sun", "sky", "day"]) * 20) for i in range(60)] + [(None, ["cat", "lone"]), (99, None)]
    df = spark.createDataFrame(rows, "unique_id long, tokens array<string>")
    model = features.word2vec_fit(df, size=8, partitions=partitions, iterations=iterations)
    assert isinstance(model, WordVectors)  # before, a model that the driver held whole
    found = {r["word"]: np.array(r["vector"]) for r in features.word_vectors(model).collect()}
    assert set(found) == {"cat", "dog", "pet", "sun", "sky", "day"}
    assert all(np.isfinite(v).all() and len(v) == 8 for v in found.values())

    def near(a, b):
        return found[a] @ found[b] / np.linalg.norm(found[a]) / np.linalg.norm(found[b])

    assert near("cat", "dog") > near("cat", "sky")
    again = features.word_vectors(features.word2vec_fit(df, size=8, partitions=partitions, iterations=iterations)).collect()
    assert {r["word"]: r["vector"] for r in again} == {w: v.tolist() for w, v in found.items()}


def test_blocks_are_trained_as_their_pairs_one_by_one(monkeypatch):
    """All pairs of a block see the vectors before it; a small slab changes nothing."""
    monkeypatch.setattr(wv, "SLAB", 50)
    rng = np.random.default_rng(5)
    counts = [2, 2, 3, 5, 8, 20, 40]
    tree = wv.huffman(sorted(set(counts)), [2, 1, 1, 1, 1, 1])
    up, side = wv.tree_paths(tree, np.arange(7))
    inner_nodes = np.unique(up[up >= 0])
    above, sides = np.where(up >= 0, np.searchsorted(inner_nodes, up), len(inner_nodes)), np.where(up >= 0, side, 0.5)
    words = rng.choice(7, 300, p=np.array(counts) / sum(counts))
    sentence = np.arange(300) // 70
    vectors, inner = rng.normal(size=(7, 6)).astype(np.float32), rng.normal(size=(len(inner_nodes) + 1, 6)).astype(np.float32)
    inner[-1] = 0
    vectors[0] *= 20  # some answers are certain
    want_x, want_y, seen = vectors.astype(float), inner.astype(float), np.zeros(7, bool)
    reach = 3 - np.random.default_rng(9).integers(0, 3, 300)
    start = 0
    for end in wv._block_ends(words):
        x, y = want_x.copy(), want_y.copy()
        for i in range(start, end):
            for j in range(max(0, i - reach[i]), min(300, i + reach[i] + 1)):
                if i == j or sentence[i] != sentence[j]:
                    continue
                seen[words[j]] = True
                for node, s in zip(above[words[i]], sides[words[i]]):
                    told = x[words[j]] @ y[node]
                    if node < len(inner_nodes) and abs(told) < wv.STEEP:
                        change = 0.05 * (1 - s - 1 / (1 + np.exp(-told)))
                        want_x[words[j]] += change * y[node]
                        want_y[node] += change * x[words[j]]
        start = end
    trained = wv.skip_gram(words, sentence, above, sides, vectors, inner, 3, lambda d: 0.05, np.random.default_rng(9))
    assert trained.tolist() == seen.tolist()
    assert np.abs(vectors - want_x).max() < 1e-4 and np.abs(inner - want_y).max() < 1e-4


def test_every_part_has_a_partition_of_its_own(spark):
    for n in (1, 8, 40):
        texts = parts.dealt(spark.range(400).select(F.col("id").alias("unique_id"), F.array(F.lit("a")).alias("tokens")), "tokens", n, "unique_id")
        found = texts.repartition(n, parts.PART).select(parts.PART, F.spark_partition_id().alias("at")).distinct().collect()
        assert len(found) == n == len({r["at"] for r in found})  # before, two of 8 parts were one task


def test_parts_grow_before_there_are_more(spark):
    """The rare words of a corpus are in nearly as many parts as they have places, and a part sends the vectors of all its words."""
    df = spark.range(100).select(F.array_repeat(F.lit("a"), 10).alias("tokens"))
    assert [parts.parts_for(df, "tokens", least, most) for least, most in ((10, 10), (10, 500), (10, 50), (400, 500), (5000, 9000))] == [100, 8, 20, 3, 1]
    assert features.MOST_WORDS_PER_PART >= 10 * features.WORDS_PER_PART  # before, 200,000 words for any corpus


def test_packs_give_all_texts_back(spark):
    rows = [(1, ["a", "b c", None]), (2, []), (3, None), (None, ["é", "a", "a"])]
    texts = parts.dealt(spark.createDataFrame(rows, "unique_id long, tokens array<string>"), "tokens", 2, "unique_id")
    packs = parts.packed(texts, "unique_id", "tokens").toArrow()
    found = [pair for batch in parts.unpacked(packs.column("_pack")) for pair in zip(*(c.to_pylist() for c in batch.columns))]
    assert sorted(found, key=str) == sorted(rows, key=str)
    known = {k: n for batch in parts.unpacked(packs.column("_pack")) for k, n in zip(batch.column(0).to_pylist(), parts.places(batch.column(1), pa.array(["a", "x"]))[1])}
    assert known == {1: 1, 2: 0, 3: 0, None: 2}


def test_vector_mean_of_repeated_and_missing_keys(spark, monkeypatch):
    monkeypatch.setattr("corpusmill.operators.aggregates.WORDS_PER_PART", 3)
    df = spark.createDataFrame(
        [(1, ["a", "a", "b"]), (1, ["b", "zz"]), (2, ["zz"]), (3, None), (None, ["a"]), (4, ["a", None])], "unique_id long, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 4.0])], "word string, vector array<double>")
    mean = vector_mean(df, "tokens", vectors, 2)
    found = sorted((r["unique_id"] or 0, [round(x, 9) for x in r["embedding"]]) for r in mean.collect())
    assert found == [(0, [0, 0]), (1, [0.5, 2]), (1, [0.5, 2]), (2, [0, 0]), (3, [0, 0]), (4, [1, 0])]
    plan = mean._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan  # before, a joined row for each word of each text


def test_scans_of_a_grid_send_little_to_the_driver():
    assert clusters.DIRECT * 300 < 1000 << 20  # 300 scans, for any number of tasks


def test_lemmas_are_looked_up_in_slices(spark, monkeypatch):
    monkeypatch.setattr(clean, "TEXTS_AT_ONCE", 2)
    rows = [(1, ["cats", None, "dogs", "cats"]), (2, None), (3, []), (4, ["sun"]), (5, ["dogs"])]
    df = spark.createDataFrame(rows, "unique_id long, tokens array<string>").coalesce(1)
    lexicon = spark.createDataFrame([("cats", "NNS")], "token string, tag string")
    lemmas = spark.createDataFrame([("cats", "n", "cat"), ("dogs", "n", "dog")], "token string, class string, lemma string")
    found = {r["unique_id"]: r["tokens"] for r in clean.lemma_lookup(df.withColumn("x", F.lit(1)), "tokens", lexicon, lemmas).collect()}
    assert found == {1: ["cat", None, "dog", "cat"], 2: None, 3: [], 4: ["sun"], 5: ["dog"]}
