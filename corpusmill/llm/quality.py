"""Quality scores by a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise interactions in
time linear in the number of features. Features are the distinct words of a text, hashed, and ten measures of its structure and of the
given length, cut into steps. The machine is fitted on the driver on at most ``sample`` labelled rows, those with the smallest
key hashes; every text is scored where it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.words import raw_texts, word_hashes

SAMPLE = 12_000  # labelled rows that the machine is fitted on
WORD_BITS = 17
STEPS = 16
MEASURES = 11
SIZE = (1 << WORD_BITS) + MEASURES * (STEPS + 1)
FACTORS = 8
#: Signs counted for structure: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line break, 6 sentence mark, 7 other sign.
KIND = np.array([
    5 if b == 10 else 4 if b in (9, 11, 12, 13, 32) else 0 if b >= 128 else 3 if chr(b).isdigit() else 1 if chr(b).islower()
    else 2 if chr(b).isupper() else 6 if chr(b) in ".,;:" else 7 for b in range(256)
])


def _structure(texts: list[bytes], words: np.ndarray, bounds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Measures of each text, each from 0 to 1."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    row = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(row * 8 + KIND[data], minlength=8 * len(texts)).reshape(-1, 8)
    n, total = np.diff(bounds), np.maximum(sizes, 1)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    lines = [[x for x in t.split(b"\n") if x] for t in texts]
    repeated = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)

    def log(x: np.ndarray, top: float) -> np.ndarray:
        return np.minimum(np.log1p(np.maximum(x, 0)) / np.log1p(top), 1)

    return np.stack([
        log(n, 20_000), log(lengths, 200_000), np.minimum(sizes / np.maximum(n, 1) / 20, 1), counts[:, 2] / letters,
        np.sqrt(counts[:, 3] / total), np.sqrt(counts[:, 7] / total), np.sqrt(counts[:, 6] / total),
        distinct / np.maximum(n, 1), repeated, np.sqrt(counts[:, 5] / total), counts[:, 0] / total,
    ], axis=1)


def features(texts: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices, values and row bounds of a sparse matrix; the words of a row have length 1 together."""
    words, bounds = word_hashes(texts)
    slots = (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    measures = _structure(texts, words, bounds, lengths)
    steps = np.minimum((measures * STEPS).astype(np.int64), STEPS)
    own = (1 << WORD_BITS) + np.arange(MEASURES) * (STEPS + 1)
    index, value, sizes = [], [], []
    for i in range(len(texts)):
        found = np.unique(slots[bounds[i] : bounds[i + 1]])
        index += [found, own + steps[i]]
        value += [np.full(len(found), 1 / np.sqrt(max(len(found), 1))), np.full(MEASURES, 1 / np.sqrt(MEASURES))]
        sizes.append(len(found) + MEASURES)
    return np.concatenate([np.zeros(0, np.int64), *index]), np.concatenate([np.zeros(0), *value]), np.cumsum([0, *sizes])


def raw_scores(model: tuple, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The machine's value of each row, before the sigmoid."""
    start, weights, factors = model
    part = bounds[:-1]
    out = start + np.add.reduceat(weights[index] * value, part)
    for f in range(factors.shape[1]):
        x = factors[index, f] * value
        out += 0.5 * (np.add.reduceat(x, part) ** 2 - np.add.reduceat(x * x, part))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    index: np.ndarray, value: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rounds: int = 6, step: float = 0.1, seed: int = 7,
) -> tuple:
    """Log-loss by AdaGrad over small batches of rows."""
    rng = np.random.default_rng(seed)
    rate = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
    start, weights = float(np.log(rate / (1 - rate))), np.zeros(SIZE)
    factors = rng.normal(0, 0.01, (SIZE, FACTORS))
    seen_start, seen_weights, seen_factors = 1e-8, np.full(SIZE, 1e-8), np.full((SIZE, FACTORS), 1e-8)
    for _ in range(rounds if len(labels) else 0):
        for rows in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 64)):
            sizes = bounds[rows + 1] - bounds[rows]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(bounds[rows] - (ends - sizes), sizes)
            i, x, part = index[at], value[at], ends - sizes
            v = factors[i] * x[:, None]
            sums = np.add.reduceat(v, part)
            raw = start + np.add.reduceat(weights[i] * x, part) + 0.5 * (sums**2 - np.add.reduceat(v * v, part)).sum(1)
            error = (sigmoid(raw) - labels[rows]) / len(rows)
            by_value = np.repeat(error, sizes) * x
            slots, where = np.unique(i, return_inverse=True)
            g = np.bincount(where, weights=by_value) + 1e-5 * weights[slots]
            seen_weights[slots] += g * g
            weights[slots] -= step * g / np.sqrt(seen_weights[slots])
            for f in range(FACTORS):
                g = np.bincount(where, weights=by_value * (np.repeat(sums[:, f], sizes) - v[:, f])) + 1e-5 * factors[slots, f]
                seen_factors[slots, f] += g * g
                factors[slots, f] -= 0.2 * step * g / np.sqrt(seen_factors[slots, f])
            seen_start += error.sum() ** 2
            start -= step * error.sum() / np.sqrt(seen_start)
    return start, weights, factors


def _given(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.array([x or 0 for x in batch.column(column).to_pylist()], dtype=np.float64)


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            index, value, bounds = features(raw_texts(batch.column(0)), _given(batch, 1))
            ends = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(index.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32))), batch.column(2).cast(pa.float64()), batch.column(1), batch.column(3)],
                names=["i", "x", "y", "chars", "h"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", label: str = "quality",
    sample: int = SAMPLE,
) -> tuple:
    """Machine fitted on labelled rows. A key with several labels has the largest; null keys and labels are left out.

    Of a key with several rows one is taken, by a hash of its text, so at most ``sample`` rows are looked at whatever the keys.
    """
    named = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("double").alias("y")).dropna()
    chosen = named.groupBy("k").agg(F.max("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(sample)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"), F.col(f"`{chars}`").cast("double").alias("chars"))
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "chars", F.col("text").cast("binary").alias("text"))).alias("one")
    found = rows.join(chosen, "k").groupBy("k", "y").agg(one).select("one.text", "one.chars", "y", "one.h")
    kind = "i array<int>, x array<float>, y double, chars double, h long"
    table = found.mapInArrow(_collected, kind).toArrow().sort_by([(c, "ascending") for c in ("h", "y", "chars")]).combine_chunks()
    if not table.num_rows:
        return train(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))
    lists = [table.column(c).combine_chunks() for c in ("i", "x")]
    sizes = lists[0].value_lengths().to_numpy()
    return train(
        lists[0].flatten().to_numpy().astype(np.int64), lists[1].flatten().to_numpy().astype(np.float64),
        np.concatenate([[0], np.cumsum(sizes)]), table.column("y").to_numpy(),
    )


def _score(model, text_column: int, chars_column: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                parts = features(raw_texts(batch.column(text_column)), _given(batch, chars_column))
                score = sigmoid(raw_scores(model.value, *parts))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "quality_score"])

    return work


def score(docs: DataFrame, model: tuple, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The columns of ``docs`` and quality_score, the chance of label 1.

    Only the text and its given length are looked at. A null text is empty, and empty texts have a score too; a null
    length is 0. Without labelled rows every score is 0.5 or near it. Repeated rows get equal scores.
    """
    docs = docs.drop("quality_score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())])
    return docs.mapInArrow(_score(sent, docs.columns.index(text), docs.columns.index(chars)), schema)
