from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import collocations as co
from corpusmill.llm import queries


def grams(texts, langs):
    counts, total = {}, Counter()
    for text, lang in zip(texts, langs, strict=True):
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    return counts, total


def brute(texts, langs, least=10, share=50, top=2000):
    counts, total = grams(texts, langs)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= share * f[p[i : i + 2]]}
        rows = []
        for p, a in candidates.items():
            if p in inside:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        for rank, r in enumerate(sorted(rows)[:top]):
            out.append((lang, rank + 1, r[2].decode(), *r[3:6], total[lang], r[6]))
    return sorted(out)


def some_texts(rng, n):
    words = [f"{c}{d}" for c in "abcé" for d in "xyz"] + ["THE", "the", "a"]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" "] * 12 + [". ", "\n", ",", "\t", "  ", "!?", "\x0b", "\x00", "\xa0"]
    return ["".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize(("chunk", "bits", "batch"), [(1 << 24, 1 << 26, "10000"), (200, 64, "3"), (1, 1024, "1")])
def test_equals_brute_force(spark, documents, monkeypatch, chunk, bits, batch):
    monkeypatch.setattr(co, "CHUNK", chunk)
    monkeypatch.setattr(co, "FILTER_BITS", bits)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rng = random.Random(chunk)
        texts = [*some_texts(rng, 120), None, "", " . ", "tail word"]
        langs = [rng.choice(["en", "de", None]) for _ in texts]
        for top in (2000, 7):
            found = co.collocations(documents(texts, langs), least=4, top=top)
            assert sorted(tuple(r) for r in found.collect()) == brute(texts, langs, 4, top=top)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_lockstep_over_any_batches_and_partitions(size):
    rng = random.Random(size)
    f = grams(some_texts(rng, 150), ["en"] * 150)[0]["en"]
    rows = sorted((*[w.encode() for w in p], *[b""] * (3 - len(p)), a) for p, a in f.items())
    for cut in (len(rows), 17):
        found, open_pairs = {}, {}
        for start in range(0, len(rows), cut):
            part = rows[start : start + cut]
            batches = (pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part[i : i + size], strict=True), [pa.binary()] * 3 + [pa.int64()], strict=True)],
                                                  names=["w1", "w2", "w3", "a"]) for i in range(0, len(part), size))
            seen, n = set(), 0
            for b in co._lockstep((1, 2))(batches):
                for r in b.to_pylist():
                    p = tuple(w.decode() for w in (r["w1"], r["w2"], r["w3"]) if w)
                    found[p], n = r, n + 1
                    if len(p) == 3 and r["two"] is None:
                        open_pairs[p[:2]] = max(open_pairs.get(p[:2], 0), r["a"])
                        seen.add(p[:2])
            assert n == len(part) and len(seen) <= 1
        for p, a in f.items():
            r = found[p]
            assert r["a"] == a and r["one"] in ((f[p[:1]], None) if len(p) > 1 and cut < len(rows) else (f[p[:1]] if len(p) > 1 else None,))
            if len(p) == 3:
                assert r["two"] in ((f[p[:2]], None) if cut < len(rows) else (f[p[:2]],))
            if len(p) == 2:
                most = max((n for q, n in f.items() if len(q) == 3 and q[:2] == p), default=0)
                assert max(r["most"], open_pairs.get(p, 0)) == most


def test_long_texts_in_chunks_count_as_whole_ones(spark, documents, monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 1 << 20)
    text = "alpha beta gamma delta " * 130_000 + "alpha. beta " + "z" * (1 << 20) + " beta gamma"
    found = sorted(tuple(r) for r in co.collocations(documents([text])).collect())
    assert found == brute([text], ["en"])


def test_exact_beyond_64_bits(spark):
    rows = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_000)], "a long, l long, r long")
    a, left, right = rows.first()
    assert rows.selectExpr(co._cut_score("l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_filters_never_lose_a_key():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    made = co.Filter(co.filter_bits(5000))
    made.add(keys)
    assert made.has(keys).all() and made.has(rng.integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.1


def test_odd_and_empty_tables(odd):
    assert co.collocations(odd.limit(0)).collect() == []
    texts = [(r["text"], r["lang"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in co.collocations(odd, least=1).collect()) == brute([t for t, _ in texts], [x for _, x in texts], least=1)


def test_query_has_its_columns(spark):
    kinds = dict(queries.op13_collocations(spark, "/root/testdata/sf0.001").dtypes)
    assert kinds == {"lang": "string", "phrase": "string", **dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")}
