from __future__ import annotations

import numpy as np
import pytest

from corpusmill.llm import training_order as to


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation_takes_every_slot_once(n):
    slots = to.permuted(np.arange(n), n, 11)
    assert sorted(slots) == list(range(n))
    assert n < 64 or (slots != to.permuted(np.arange(n), n, 12)).any()


def plain(texts, length):
    out = []
    for i, t in enumerate(texts):
        data = (t or "").encode() + bytes([to.BYTE_END])
        out += [(i, k // length, data[k : k + length].ljust(length, bytes([to.BYTE_PAD]))) for k in range(0, len(data), length)]
    return out


def test_shards_read_back(spark, documents, tmp_path):
    texts = ["x" * n for n in (0, 1, 15, 16, 17, 500)] + [None, "é" * 40, "same", "same"]
    rows = documents(texts).selectExpr("doc_id", "cast(text as binary) as tokens", "'c' as part")
    out = f"file://{tmp_path}/shards"
    index, n = to.materialise(rows, "tokens", out, length=16, key=5, per_shard=7)
    expected = plain(texts, 16)
    assert n == len(expected)
    found = to.read_back(index, out, 16).collect()
    assert {(r["doc_id"], r["chunk"], bytes(r["payload"])) for r in found} == set(expected)
    assert sorted(r["slot"] for r in found) == list(range(n)) and all(r["shard"] == r["slot"] // 7 for r in found)
    # A reader finds any slot by its number alone.
    by_slot = {r["slot"]: bytes(r["payload"]) for r in found}
    for slot in range(n):
        data = (tmp_path / "shards" / to.shard_name(slot // 7)).read_bytes()
        assert data[(slot % 7) * 16 : (slot % 7 + 1) * 16] == by_slot[slot]


def test_token_arrays(spark, tmp_path):
    rows = spark.createDataFrame([(1, [5, 6, 7]), (2, []), (3, None)], "doc_id long, ids array<int>")
    out = f"file://{tmp_path}/ids"
    index, n = to.materialise(rows, "ids", out, length=2, kind="uint16", end=1, pad=0, key=3)
    found = {(r["doc_id"], r["chunk"]): np.frombuffer(bytes(r["payload"]), np.uint16).tolist()
             for r in to.read_back(index, out, 4).collect()}
    assert n == 4 and found == {(1, 0): [5, 6], (1, 1): [7, 1], (2, 0): [1, 0], (3, 0): [1, 0]}


def test_empty_table_and_clashing_names(spark, odd, documents, tmp_path):
    rows = odd.selectExpr("*", "cast(text as binary) as tokens", "1 as slot", "2 as shard", "3 as payload").drop("text")
    index, n = to.materialise(rows, "tokens", f"file://{tmp_path}/odd", length=1024)
    assert index.count() == n and index.agg({"slot": "max"}).first()[0] == n - 1
    none = documents([]).selectExpr("doc_id", "cast(text as binary) as tokens")
    index, n = to.materialise(none, "tokens", f"file://{tmp_path}/none")
    assert n == 0 and index.count() == 0
