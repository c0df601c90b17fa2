"""Pair counts with the bucket filter: the filter works inside the product, and no pair of a basket is a row."""

from __future__ import annotations

from collections import Counter
from hashlib import md5
from itertools import combinations

from corpusmill.operators import itemsets as it


def test_pairs_of_frequent_buckets(spark, monkeypatch):
    monkeypatch.setattr("corpusmill.operators.vertical.BLOCK", 3)  # several blocks of items
    baskets = [sorted({"é", *[f"w{(i * k) % 11}" for k in range(1, 6)]}) for i in range(30)] + [[], None, ["w1"]]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "unique_id long, items array<string>")
    chosen = [0, 2, 3, 6]

    def bucket(a, b):
        return sum(int(md5(x.encode()).hexdigest()[:8], 16) % 7 for x in (a, b)) % 7

    expected = Counter(p for b in baskets for p in combinations(b or [], 2) if bucket(*p) in chosen)
    found = it.pair_counts(df, spark.createDataFrame([(c,) for c in chosen], "bucket int"), 7)
    assert {(r["a"], r["b"]): r["cnt"] for r in found.collect()} == expected
    assert found.where(it.pair_bucket("a", "b", 7).isin(chosen)).count() == len(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan  # before, a row for each pair of each basket
