"""Columns, kinds and folds of the registered queries, over the smallest given tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from pathlib import Path

import pytest

from corpusmill.llm import langid
from corpusmill.llm.queries import queries

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}


def result(spark, start, kinds):
    """Rows of the query whose name begins so, by doc_id, after a look at the kinds of its columns."""
    found = next(q for name, q in queries().items() if name.startswith(start))(spark, TABLES)
    have = dict(found.dtypes)
    assert {c: have.get(c) for c in kinds} == kinds
    rows = found.collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(by_id) == len(rows)
    return by_id


def remainder(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def test_language_id(spark, texts):
    rows = result(spark, "op5_", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"})
    assert rows.keys() == texts.keys()
    assert all(r["held_out"] == (remainder(i, 4) == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())


def test_quality(spark, texts):
    rows = result(spark, "op10_", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"})
    assert rows.keys() == texts.keys()
    assert all(r["held_out"] == (remainder(i, 4) == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())


# The patterns that the contract names: kind, pattern, group and least length of the group.
PATTERNS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def test_secrets(spark, texts):
    kinds = {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}
    rows = result(spark, "op6_", kinds)
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        found = []
        for number, (kind, pattern, group, least) in enumerate(PATTERNS):
            found += [(m.start(), number, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
        spans = [span for *_, span in sorted(found)]
        row = rows[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s.startswith(k) for s in spans) for k, *_ in PATTERNS]
        assert set(spans) <= set(row["spans"].split(","))


def test_near_duplicates(spark, texts):
    rows = result(spark, "op9_", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"})
    assert rows.keys() == texts.keys()
    # Every document against every other, as a union of links.
    sets = {}
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        sets[doc_id] = {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    for i, r in rows.items():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), root[i], root[i] == i)


def test_languages_by_plain_rank_orders(documents):
    """Profiles and distances as plain lists: a missing n-gram is as far away as the profile is long."""
    learned = {"p": "kita mako tiko kita", "q": "splen dorf gluck splen", "r": "kita dorf"}
    asked = ["mako mako kita", "gluck", "kita dorf", "zzz", "dorf mako tiko splen", "AB-c1d"]

    def order(text, top):
        runs = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        grams = [runs[i : i + n] for n in (1, 2, 3) for i in range(len(runs) - n + 1)]
        grams = [g for g in grams if g.strip() and not (len(g) == 3 and g[1] == " ")]
        packed = [sum((1 if c == " " else ord(c) + 1) << 21 * (len(g) - 1 - k) for k, c in enumerate(g)) for g in grams]
        return sorted(set(packed), key=lambda g: (-packed.count(g), g))[:top]

    for top in (10, 400):
        profiles = langid.learn(documents(list(learned.values()), list(learned)), top=top)
        found = langid.predict(documents(asked), profiles, top=top).orderBy("doc_id").collect()
        for text, row in zip(asked, found, strict=True):
            own, apart = order(text, top), {}
            for name, sample in sorted(learned.items()):
                places = {g: k for k, g in enumerate(order(sample, top))}
                apart[name] = sum(abs(places[g] - k) if g in places else top for k, g in enumerate(own))
            assert row["lang_pred"] == min(apart, key=lambda name: (apart[name], name))
