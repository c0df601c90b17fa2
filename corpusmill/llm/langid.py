"""Language identification by rank-order n-gram profiles and the out-of-place distance.

N-grams are runs of one to three letters and word bounds of the lower-cased text. A language's profile is its ``top`` most
frequent n-grams over all training texts; a text's profile is its own. The distance sums, over the text's
profile, how far each n-gram stands from its place in the language's profile, ``top`` where it has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

TOP = 400
UNKNOWN = "und"
SLICE = 1 << 20  # characters that are turned into n-grams at once


def letter_codes(text: str) -> np.ndarray:
    """Code point + 1 of the lower-cased letters, and one 1 for each run of anything else and for both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(points) and points.max() < 0x800:
        kinds, where = np.arange(points.max() + 1), points
    else:
        kinds, where = np.unique(points, return_inverse=True)
    is_letter = np.array([chr(k).isalpha() for k in kinds.tolist()], dtype=bool)
    codes = np.concatenate([[1], np.where(is_letter, kinds + 1, 1)[where], [1]]) if len(points) else np.ones(2, np.int64)
    return codes[np.concatenate([[True], (codes[1:] != 1) | (codes[:-1] != 1)])]


def _grams(codes: np.ndarray, start: int) -> np.ndarray:
    """N-grams that begin in a slice, their places packed into one integer each."""
    part = codes[start : start + SLICE + 2]
    one = part[:SLICE]
    two = (part[:-1] << 21 | part[1:])[:SLICE]
    three = (part[:-2] << 42 | part[1:-1] << 21 | part[2:])[:SLICE]
    return np.concatenate([one[one != 1], two, three[part[1:-1][: len(three)] != 1]])


def _add(found: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if found is None:
        return keys, n
    every, where = np.unique(np.concatenate([found[0], keys]), return_inverse=True)
    return every, np.bincount(where, weights=np.concatenate([found[1], n])).astype(np.int64)


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, sorted, and how often each occurs."""
    found = None
    for start in range(0, len(codes), SLICE):
        found = _add(found, *np.unique(_grams(codes, start), return_counts=True))
    return found


def profile_of(codes: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, ties to the smaller code."""
    keys, n = gram_counts(codes)
    return keys[np.argsort(-n, kind="stable")[:top]]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language in the rows of a task."""
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, n) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])

    for batch in batches:
        waiting: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for i, (lang, text) in enumerate(rows):
            codes = letter_codes(text)
            waiting.setdefault(lang, []).append(codes)
            sizes[lang] = sizes.get(lang, 0) + len(codes)
            if sizes[lang] >= SLICE:
                found[lang] = _add(found.get(lang), *gram_counts(np.concatenate(waiting.pop(lang))))
                sizes[lang] = 0
        for lang, parts in waiting.items():
            found[lang] = _add(found.get(lang), *gram_counts(np.concatenate(parts)))
        if sum(len(k) for k, _ in found.values()) > 2_000_000:
            yield from out()
            found = {}
    yield from out()


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> list[tuple[str, list[int]]]:
    """Profile of each language, from all rows whose text and language are not null.

    The driver gets ``top`` n-grams for each distinct language, whatever the number of texts.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    counts = rows.mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.desc("n"), "gram"]
    # First within parts of a language, as one language may hold most n-grams.
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(64)))
    salted = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("r") <= top)
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("r") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in ranked.select("lang", "gram", "r").collect():
        found.setdefault(row["lang"], []).append((row["r"], row["gram"]))
    return [(name, [gram for _, gram in sorted(found[name])]) for name in sorted(found)]


def _predict(profiles: list[tuple[str, list[int]]], top: int, text_column: int) -> Callable:
    names = [name for name, _ in profiles]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unique(np.array([g for _, grams in profiles for g in grams], dtype=np.int64))
        places = np.full((len(known) + 1, len(names)), -1, dtype=np.int64)
        for column, (_, grams) in enumerate(profiles):
            places[np.searchsorted(known, grams), column] = np.arange(len(grams))
        for batch in batches:
            lang, score = [], []
            for text in batch.column(text_column):
                codes = letter_codes(text.as_py() or "")
                if not names or not (codes != 1).any():
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                own = profile_of(codes, top)
                at = np.searchsorted(known, own)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
                place = places[at]
                apart = np.where(place < 0, top, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
                near = 1 - apart / (top * len(own))
                lang.append(names[int(apart.argmin())])
                score.append(float(near.max() / near.sum()) if near.sum() > 0 else 1 / len(names))
            arrays = [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "lang_pred", "lang_score"])

    return work


def predict(docs: DataFrame, profiles: list[tuple[str, list[int]]], text: str = "text", top: int = TOP) -> DataFrame:
    """The columns of ``docs`` and lang_pred, lang_score.

    The language is the one at the smallest distance, ties to the first name; the score is its share of the
    closeness of all languages. A text that is null or has no letter, and every text when nothing was learned, gets
    ``und`` and 0. Only the text is looked at.
    """
    docs = docs.drop("lang_pred", "lang_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return docs.mapInArrow(_predict(profiles, top, docs.columns.index(text)), schema)
