from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import near_dedup as nd
from corpusmill.llm.components import components
from corpusmill.llm.words import PIECE, pieces, shingle_set, word_hashes


def brute_components(texts: dict, k: int, percent: int) -> dict:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


@pytest.mark.parametrize("blocks", [(1024, 512), (4, 3)])
def test_components_equal_brute_force(documents, blocks):
    rng = random.Random(5)
    texts = []
    for _ in range(4):
        base = [f"w{rng.randrange(900)}" for _ in range(150)]
        texts += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.08]))) for _ in range(22)]
    texts += ["one two", "ONE two", "one", "", None, "  \n"]
    expected = brute_components(dict(enumerate(texts)), 3, 85)
    found = nd.near_duplicates(documents(texts), k=3, percent=85, sketch_block=blocks[0], set_block=blocks[1]).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_odd_rows(odd):
    found = nd.near_duplicates(odd).collect()
    assert len(found) == odd.count() and "row" in found[0].asDict()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by[3]] == [3, 3] and sum(r["first"] for r in by[3]) == 1
    assert by[None][0]["component_id"] == 3 and not by[None][0]["kept"]
    for i in (1, 2, 4):  # no words: a group of its own
        assert by[i][0]["n_shingles"] == 0 and by[i][0]["first"] and by[i][0]["component_id"] == i


def test_group_without_keys_keeps_one_row(documents):
    found = nd.near_duplicates(documents(["a b c d e f"] * 3, ids=[None] * 3)).collect()
    assert [r["component_id"] for r in found] == [None] * 3 and sum(r["first"] for r in found) == 1


def test_empty_table(documents):
    assert nd.near_duplicates(documents([])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    for keep in (1800, 1000, 200):
        b = np.concatenate([a[:keep], rng.integers(0, 2**63, 2000 - keep).astype(np.uint64)])
        true = keep / (4000 - keep)
        same = (nd.signature(a, 512) == nd.signature(b, 512)).mean()
        assert abs(same - true) < 4.5 * (true * (1 - true) / 512) ** 0.5


def test_long_texts_hash_as_short_ones():
    text = b"alpha beta\ngamma " * (PIECE // 8)
    assert b"".join(pieces(text)) == text
    words, bounds = word_hashes([b"x", text, b"alpha"])
    assert bounds.tolist() == [0, 1, 1 + 3 * (PIECE // 8), 2 + 3 * (PIECE // 8)]
    assert set(words[1:-1].tolist()) == set(word_hashes([b"alpha beta gamma"])[0].tolist())
    assert len(shingle_set(words[1:-1], 5)) == 3


def test_bands_find_threshold_pairs():
    for t in (0.5, 0.8, 0.85, 0.95):
        assert (1 - t**nd.ROWS) ** nd.band_count(t) <= nd.MISS


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_names_of_the_caller_are_kept(documents):
    names = ["nd_row", "nd_size", "nd_digest", "nd_bands", "nd_least", "own_0", "own_1", "root", "a.b"]
    docs = documents(["one two three four five six", "one two three four five six", None]).withColumns({n: F.lit(f"own {n}") for n in names})
    found = nd.near_duplicates(docs)
    assert found.columns == [*docs.columns, "n_shingles", "component_id", "kept", "first"]
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    assert all(r[n] == f"own {n}" for r in rows for n in names)
    assert [(r["component_id"], r["kept"]) for r in rows] == [(0, True), (0, False), (2, True)]
