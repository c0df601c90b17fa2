"""Pair and triplet counts from vertical bit sets.

A task turns a slice of its baskets on its side: one row per item, one bit per basket. Pairs are then one matrix product, and a
triplet is the AND of a frequent pair's bits with those of a common partner. A task sends a row for each set that it counted,
with its count; no pair or triplet of a basket is ever a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 4096  # baskets of one matrix product; counts of so many are exact in single precision
BLOCK = 1024  # items of one side of it
HELD_PAIRS = 2_000_000  # counted pairs that a task keeps before it sends them on
BITS = 1 << 27  # bits (as bytes while they are set) of one slice of triplet counting
MAX_PAIRS = 100_000  # frequent pairs, and
MAX_TRIPLETS = 2_000_000  # triplets of them, that are sent to every task


def _flat(column: pa.ListArray) -> tuple[np.ndarray, pa.Array, int]:
    """Row of each item, the items, and the number of rows; a null basket has no item."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths), column.flatten(), len(column)


class _Names:
    """Numbers of the items that a task has met."""

    def __init__(self):
        self.numbers: dict[str, int] = {}

    def of(self, items: pa.Array) -> np.ndarray:
        return np.array([self.numbers.setdefault(x, len(self.numbers)) for x in items.to_pylist()], dtype=np.int64)


def _residues(items: pa.Array, buckets: int) -> np.ndarray:
    """Leading 32 bits of each item's MD5, modulo the number of buckets, as ``itemsets.item_residue``."""
    return np.array([int(md5(x.encode()).hexdigest()[:8], 16) % buckets for x in items.to_pylist()], dtype=np.int64)


def _slice_pairs(column: pa.ListArray, names: _Names, marks: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys (two numbers of items) and counts of the pairs of a slice, block by block; with ``marks`` those of marked buckets only."""
    row, items, rows = _flat(column)
    coded = items.dictionary_encode()
    number, local = names.of(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    residue = None if marks is None else _residues(coded.dictionary, len(marks))

    def matrix(start: int) -> np.ndarray:
        out = np.zeros((rows, min(BLOCK, len(number) - start)), np.float32)
        here = (local >= start) & (local < start + BLOCK)
        out[row[here], local[here] - start] = 1
        return out

    for i in range(0, len(number), BLOCK):
        left = matrix(i)
        for j in range(i, len(number), BLOCK):
            together = left.T @ (left if i == j else matrix(j))
            if marks is not None:
                bucket = (residue[i : i + BLOCK, None] + residue[j : j + BLOCK]) % len(marks)
                together = together * marks[bucket]
            a, b = np.nonzero(np.triu(together, 1) if i == j else together)
            yield number[a + i] << 32 | number[b + j], together[a, b].astype(np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch], marks: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    names = _Names()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in held])
        a, b = keys >> 32, keys & 0xFFFFFFFF
        distinct, where = np.unique(np.minimum(a, b) << 32 | np.maximum(a, b), return_inverse=True)
        return distinct, np.bincount(where, weights=np.concatenate([n for _, n in held])).astype(np.int64)

    def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        items = np.array(list(names.numbers), dtype=object)
        a, b = items[keys >> 32], items[keys & 0xFFFFFFFF]
        swap = a > b  # code points are in the order of UTF-8 bytes
        a[swap], b[swap] = b[swap], a[swap]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(counts)], names=["a", "b", "cnt"])

    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            for part in _slice_pairs(batch.column(0).slice(start, SLICE), names, marks):
                held.append(part)
                size += len(part[0])
                if size >= HELD_PAIRS:
                    held = [merged()]
                    size = len(held[0][0])
            if held and size >= HELD_PAIRS // 2:  # between slices, as a slice has its items' numbers at hand
                yield out(*merged())
                names, held, size = _Names(), [], 0
    if held:
        yield out(*merged())


def pair_counts(baskets: DataFrame, marks: list[bool] | None = None) -> DataFrame:
    """(a, b, cnt), a < b, of all pairs of the baskets' items; with ``marks``, one for each bucket, of the pairs of marked buckets."""
    marked = None if marks is None else np.array(marks, np.float32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_pairs(batches, marked)

    counted = baskets.select("items").mapInArrow(count, "a string, b string, cnt long")
    return counted.groupBy("a", "b").agg(F.sum("cnt").alias("cnt"))


class Partners(NamedTuple):
    """Frequent pairs by the numbers of their items, and the items that make a triplet with each."""

    items: list[str]
    a: np.ndarray
    b: np.ndarray
    bounds: np.ndarray  # where each pair's third items begin in ``c``
    c: np.ndarray


def partners(pairs: DataFrame) -> Partners | None:
    """The triplets whose three pairs are all in ``pairs``; None if they are too many to be sent to the tasks."""
    rows = pairs.select("a", "b").limit(MAX_PAIRS + 1).collect()
    if len(rows) > MAX_PAIRS:
        return None
    items = sorted({r["a"] for r in rows} | {r["b"] for r in rows})
    number = {x: i for i, x in enumerate(items)}
    both = sorted((number[r["a"]], number[r["b"]]) for r in rows)
    later: dict[int, set[int]] = {}
    for a, b in both:
        later.setdefault(a, set()).add(b)
    thirds, total = [], 0
    for a, b in both:
        thirds.append(sorted(later[a] & later.get(b, set())))
        total += len(thirds[-1])
        if total > MAX_TRIPLETS:
            return None
    bounds = np.cumsum([0, *map(len, thirds)])
    return Partners(items, *np.array(both, np.int64).reshape(-1, 2).T, bounds, np.array([c for t in thirds for c in t], np.int64))


def _bits(column: pa.ListArray, number: dict[str, int]) -> np.ndarray:
    """One row per item, one bit per basket, in 64-bit words."""
    row, items, rows = _flat(column)
    coded = items.dictionary_encode()
    to = np.array([number.get(x, -1) for x in coded.dictionary.to_pylist()], dtype=np.int64)
    of = to[coded.indices.to_numpy(zero_copy_only=False)] if len(items) else np.zeros(0, np.int64)
    there = np.zeros((len(number), -(-rows // 64) * 64), dtype=bool)
    there[of[of >= 0], row[of >= 0]] = True
    return np.packbits(there, axis=1).view(np.uint64)


def _marks(chosen: np.ndarray) -> np.ndarray:
    there = np.zeros(-(-len(chosen) // 64) * 64, dtype=bool)
    there[: len(chosen)] = chosen
    return np.packbits(there).view(np.uint64)


def _count_triplets(sent) -> Callable:
    """Counts of the known triplets in all baskets, and in those of label 1 and 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, a, b, bounds, c = sent.value
        number = {x: i for i, x in enumerate(items)}
        total = np.zeros((3, len(c)), np.int64)
        rows = max(64, BITS // max(len(items), 1) // 64 * 64)
        wanted = np.flatnonzero(np.diff(bounds))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                bits = _bits(part.column(0), number)
                label = part.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
                masks = [_marks(label == 1), _marks(label == 0)]
                for p in wanted.tolist():
                    pair = bits[a[p]] & bits[b[p]]
                    if not pair.any():
                        continue
                    at = slice(bounds[p], bounds[p + 1])
                    three = bits[c[at]] & pair
                    total[0, at] += np.bitwise_count(three).sum(1, dtype=np.int64)
                    for i, mask in enumerate(masks):
                        total[1 + i, at] += np.bitwise_count(three & mask).sum(1, dtype=np.int64)
        seen = np.flatnonzero(total[0])
        pair = np.searchsorted(bounds, seen, side="right") - 1
        names = pa.array(items, pa.string())
        columns = [names.take(pa.array(x)) for x in (a[pair], b[pair], c[seen])]
        yield pa.RecordBatch.from_arrays([*columns, *[pa.array(n[seen]) for n in total]], names=["a", "b", "c", "cnt", "cnt_1", "cnt_0"])

    return work


def triplet_counts(baskets: DataFrame, known: Partners, label: str | None = "label") -> DataFrame:
    """(a, b, c, cnt, cnt_1, cnt_0), a < b < c, of the known triplets that occur; no label counts in neither class."""
    sent = baskets.sparkSession.sparkContext.broadcast(tuple(known))
    classes = F.col(label).cast("int") if label else F.lit(None).cast("int")
    counted = baskets.select("items", classes.alias("label")).mapInArrow(
        _count_triplets(sent), "a string, b string, c string, cnt long, cnt_1 long, cnt_0 long")
    return counted.groupBy("a", "b", "c").agg(*[F.sum(n).alias(n) for n in ("cnt", "cnt_1", "cnt_0")])
