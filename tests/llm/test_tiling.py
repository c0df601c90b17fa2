from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from corpusmill.llm import tiling


def plain_tiles(item, text, least):
    """Greedy string tiling by comparing every pair of places."""
    p_free, t_free, out = [True] * len(item), [True] * len(text), []
    while True:
        best, matches = least, []
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and p_free[p + n] and t_free[t + n]:
                    n += 1
                if n > best or (n == best and not matches):
                    best, matches = n, [(p, t)]
                elif n == best:
                    matches.append((p, t))
        if not matches or best < least:
            return out
        for p, t in matches:
            if all(p_free[p : p + best]) and all(t_free[t : t + best]):
                p_free[p : p + best] = t_free[t : t + best] = [False] * best
                out.append((t, p, best))


@pytest.mark.parametrize("size, kept", [(1 << 19, 1 << 18), (5, 1), (1, 3)])
def test_tiles_equal_plain_tiling(monkeypatch, size, kept):
    monkeypatch.setattr(tiling, "SLICE", size)
    monkeypatch.setattr(tiling, "KEPT", kept)
    rng = random.Random(6)
    for _ in range(300):
        letters = rng.choice(["ab", "abcdefgh"])
        item = [rng.choice(letters) for _ in range(rng.randrange(0, 14))]
        text = [rng.choice(letters) for _ in range(rng.randrange(0, 25))]
        if rng.random() < 0.5 and item:
            cut = rng.randrange(len(item))
            text += item[cut:] + ["z"] + item[:cut]
        codes = [np.array([ord(c) for c in s], dtype=np.uint64) for s in (item, text)]
        found, plain = tiling.tiles(*codes, 3), plain_tiles(item, text, 3)
        assert [n for _, _, n in found] == [n for _, _, n in plain], (item, text, found, plain)
        assert found == plain


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def find(spark, documents, texts, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = tiling.contamination(documents(texts), bench, **options).collect()
    return {r["doc_id"]: [(m["item_id"], round(m["coverage"], 3)) for m in r["matches"]] for r in rows}


def test_reordered_and_changed_passages(spark, documents):
    reordered = "x y eta theta iota KAPPA, lambda! mu and then alpha beta gamma delta epsilon zeta q"
    half = "alpha beta gamma delta something else entirely here iota kappa"
    found = find(spark, documents, [f"so {ITEM} it is", reordered, half, "nothing of it", ITEM.upper()], [(9, ITEM)])
    assert found == {0: [(9, 1.0)], 1: [(9, 1.0)], 2: [], 3: [], 4: [(9, 1.0)]}


def test_blocks_of_items_give_the_same(spark, documents, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(12)] + [(3, ITEM), (None, ITEM)]
    texts = [t for _, t in items[:6]] + [f"{items[2][1]} and {ITEM}"]
    one = find(spark, documents, texts, items)
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 200)
    monkeypatch.setattr(tiling, "TEXT_BYTES", 100)
    for most in (64 << 20, 500):
        monkeypatch.setattr(tiling, "PASS_BYTES", most)
        many = find(spark, documents, texts, items)
        assert {k: sorted(map(str, x)) for k, x in one.items()} == {k: sorted(map(str, x)) for k, x in many.items()}
    assert len(one[6]) == 3


def test_repeated_items_are_told_each(spark, documents):
    found = find(spark, documents, [ITEM, "no"], [(9, ITEM), (8, ITEM), (9, ITEM), (9, "something else of five")])
    assert sorted(found[0]) == [(8, 1.0), (9, 1.0), (9, 1.0)] and found[1] == []


def test_repeated_tokens_take_bounded_memory():
    item, text = np.full(1_000, 7, dtype=np.uint64), np.full(200_000, 7, dtype=np.uint64)
    tracemalloc.start()
    assert tiling.tiles(item, text, 4) == [(0, 0, 1_000)]
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_odd_rows(spark, odd, documents):
    items = [(1, ITEM), (2, None), (3, ""), (4, "two words"), (5, "the cat sat on the mat")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = tiling.contamination(odd, bench).collect()
    assert len(found) == odd.count() and sum(len(r["matches"]) for r in found) == 3
    assert tiling.contamination(documents([]), bench).count() == 0
    assert [r["matches"] for r in tiling.contamination(odd, bench.where("item_id < 0")).collect()] == [[]] * len(found)
