"""Brown class-based n-gram scoring: exchange clustering, class transitions, word emissions.

Tokens are the words of a text and one end. A unit is a frequent word, or all rarer words with one hash of their last
two bytes; exchange clustering moves units between classes so that the likelihood of adjacent classes grows. Every
rarer word that occurs ``FLOOR`` times or more then gets the best class for its own neighbours; only words under the floor
keep the class of their unit. All counts are over all training texts:

1. words are counted in each task and summed by Spark;
2. adjacent units are counted in the same way; each unit's neighbours become one row;
3. in every round each task finds the best class of its units against the classes of the round before, half of the
   units at a time, and the new class matrix is summed;
4. the neighbours of every rarer word that reaches the floor are counted by class, brought together in the order of the words,
   and its class is found from their sums;
5. adjacent classes are counted again with the classes of all words;
6. texts are scored where they are. The most frequent ``LOOKUP_WORDS`` words are looked up in the task, counts and classes of
   the others by a join. In step 5 only words that have a class of their own, as far as a filter can tell, are joined.

Each pass numbers the different words of a run of texts first, so that a word is looked up once for the run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.collocations import Filter, filter_of, made_filter, word_hashes
from corpusmill.llm.words import IN_WORD, pieces, raw_texts
from corpusmill.sources.staging import stage

END = b"\n"  # no word holds a line break
UNIT_SHARE = 1e-4  # share of the tokens from which a word is a unit of its own: at most 10,000 words
FLOOR = 5  # count from which a rarer word gets a class of its own
LOOKUP_WORDS = 500_000  # words whose counts are looked up in the task; the counts of the others are joined
TAILS = 256  # units of rarer words
SLICE = 4 << 20  # bytes of text whose paths a task follows at once
HELD_WORDS = 1_000_000  # words that a task counts before it hands them on
HELD_PAIRS = 4_000_000
HELD_NEAR = 300_000  # rarer words whose neighbours a task counts before it hands them on
#: Tail of each last byte of a word of one byte, and of each last two bytes.
TAILS_OF_1 = np.array([crc32(bytes([b])) % TAILS for b in range(256)])
TAILS_OF_2 = np.array([crc32(bytes([a, b])) % TAILS for a in range(256) for b in range(256)])


class _Coded(NamedTuple):
    """The different words of some texts, the number of each text's words one after another, and how many each text has."""

    words: pa.Array
    ids: np.ndarray
    lengths: np.ndarray


def _coded(texts: list[bytes]) -> _Coded:
    data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])])
    found = words.dictionary_encode()
    bounds = np.cumsum([0, *[len(x) + 1 for x in texts]])
    return _Coded(found.dictionary, found.indices.to_numpy(), np.diff(np.searchsorted(starts, bounds)))


def _listed(words: pa.Array) -> list[bytes]:
    """As ``to_pylist``, without a scalar for each word on the way."""
    return words.to_numpy(zero_copy_only=False).tolist()


def _tails(words: pa.Array) -> np.ndarray:
    """Tail of each word: crc32 of its last two bytes, or its only one."""
    if not len(words):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    last = offsets[1:] - 1
    return np.where(np.diff(offsets) > 1, TAILS_OF_2[data[last - 1] * np.int64(256) + data[last]], TAILS_OF_1[data[last]])


def _tails_of(words: list[bytes]) -> np.ndarray:
    return _tails(pa.array(words, pa.binary()))


def _with_ends(ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The words of texts one after another, an end before the first, between two texts and after the last."""
    out = np.full(len(ids) + len(lengths) + 1, end, dtype=np.int64)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths) + 1] = ids
    return out


class _Numbers(dict):
    """Number of each word, given when it is first asked for."""

    def __init__(self):
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n


def _runs_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The pieces of the texts in runs of about ``SLICE`` bytes."""
    run, size = [], 0
    for text in texts:
        for piece in pieces(text):
            run.append(piece)
            size += len(piece)
            if size >= SLICE:
                yield run
                run, size = [], 0
    if run:
        yield run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    held: list[pa.Table] = []
    size = ends = 0

    def merged() -> pa.Table:
        summed = pa.concat_tables([kinds.empty_table(), *held]).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table([summed.column("word"), summed.column("n_sum")], schema=kinds)

    for batch in batches:
        texts = raw_texts(batch.column(0))
        ends += len(texts)
        for run in _runs_of(texts):
            found = _coded(run)
            held.append(pa.table([found.words, np.bincount(found.ids, minlength=len(found.words))], schema=kinds))
            size += len(found.words)
            if size >= 2 * HELD_WORDS:
                held = [merged()]
                size = held[0].num_rows
                if size >= HELD_WORDS:
                    yield from held[0].to_batches(100_000)
                    held, size = [], 0
    if ends:
        held.append(pa.table([[END], [ends]], schema=kinds))
    yield from merged().to_batches(100_000)


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all ``texts``; words as bytes, the end as a line break."""
    parts = texts.select(F.col(f"`{text}`").cast("binary")).mapInArrow(_count_words, "word binary, n long")
    return stage(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _units(found: _Coded, own: dict[bytes, int], first_tail: int) -> np.ndarray:
    """Unit of every token of some texts, an end before the first word, between two texts and after the last word."""
    of = np.fromiter(map(own.get, _listed(found.words), repeat(-1)), np.int64, len(found.words))
    of = np.where(of < 0, first_tail + _tails(found.words), of)
    return _with_ends(of[found.ids], found.lengths, first_tail + TAILS)


def _count_pairs(frequent) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {w: i for i, w in enumerate(frequent.value)}
        width = len(own) + TAILS + 1
        held: list[np.ndarray] = []
        size = 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(held), return_counts=True) if held else (keys[:0], counts[:0])
            every, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, where, np.concatenate([counts, n]))
            return every, total

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array((keys // width).astype(np.int32)), pa.array((keys % width).astype(np.int32)), pa.array(counts)],
                names=["a", "b", "n"],
            )

        for batch in batches:
            texts = raw_texts(batch.column(0))
            for part in _slices(texts):
                units = _units(_coded(texts[part]), own, len(own))
                held.append(units[:-1] * width + units[1:])
                size += len(units)
                if size >= HELD_PAIRS // 2:
                    keys, counts = merged()
                    held, size = [], 0
                    if len(keys) >= HELD_PAIRS:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield out()

    return work


def _neighbours(pairs: DataFrame) -> DataFrame:
    """One row per unit: its successors and predecessors with counts. A list is no longer than the units are many."""
    right = pairs.groupBy(F.col("a").alias("unit")).agg(F.collect_list("b").alias("r"), F.collect_list("n").alias("rn"))
    left = pairs.groupBy(F.col("b").alias("unit")).agg(F.collect_list("a").alias("l"), F.collect_list("n").alias("ln"))
    return stage(right.join(left, "unit", "full").select("unit", "r", "rn", "l", "ln"), "neighbours")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of the classes of adjacent units and of the units in their classes, up to a constant."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(1)).sum() - _xlogx(matrix.sum(0)).sum())


def best_class(matrix: np.ndarray, now: int, right: np.ndarray, left: np.ndarray, self_pairs: float) -> int:
    """Class of a unit with the largest gain; class 0 holds the end alone.

    ``right`` and ``left`` count the unit's neighbours by class, without itself.
    """
    g = matrix.astype(np.float64)
    some_right, some_left = np.flatnonzero(right), np.flatnonzero(left)  # elsewhere nothing is gained
    g[now, :] -= right
    g[:, now] -= left
    g[now, now] -= self_pairs
    rows, columns = g.sum(1) + left, g.sum(0) + right  # these hold wherever the unit goes
    diagonal = np.arange(len(g))
    after, before = g[:, some_right], g.T[:, some_left]
    gain = (_xlogx(after + right[some_right]) - _xlogx(after)).sum(1)
    gain += (_xlogx(before + left[some_left]) - _xlogx(before)).sum(1)
    own = g[diagonal, diagonal]
    gain -= _xlogx(own + right) + _xlogx(own + left) - 2 * _xlogx(own)
    gain += _xlogx(own + right + left + self_pairs) - _xlogx(own)
    r, c = right.sum() + self_pairs, left.sum() + self_pairs
    gain -= _xlogx(rows + r) - _xlogx(rows) + _xlogx(columns + c) - _xlogx(columns)
    gain[0] = -np.inf
    best = int(gain.argmax())
    return best if gain[best] > gain[now] + 1e-6 else now


def best_classes(matrix: np.ndarray, now: np.ndarray, right: np.ndarray, left: np.ndarray, self_pairs: np.ndarray) -> np.ndarray:
    """``best_class`` of many units at once, each moved alone: a row of ``right`` and ``left`` for each."""
    at, count = np.arange(len(now)), len(matrix)
    here = np.zeros((len(now), count), dtype=bool)
    here[at, now] = True

    def towards(near: np.ndarray, other: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Gain of the pairs with one side: ``g`` has a row for each neighbour class and a column for each class to go to."""
        unit, to = np.nonzero(near)
        n = near[unit, to][:, None]
        cells = g[to].astype(np.float64)
        cells[np.arange(len(unit)), now[unit]] -= n[:, 0]
        own = np.flatnonzero(to == now[unit])  # the unit's own class as a neighbour has lost the other side too
        cells[own] -= other[unit[own]]
        cells[own, now[unit[own]]] -= self_pairs[unit[own]]
        out = np.zeros((len(now), count))
        some, starts = np.unique(unit, return_index=True)
        if len(some):
            out[some] = np.add.reduceat(_xlogx(cells + n) - _xlogx(cells), starts, axis=0)
        return out

    gain = towards(right, left, matrix.T) + towards(left, right, matrix)
    r, c = right.sum(1) + self_pairs, left.sum(1) + self_pairs
    rows, columns = matrix.sum(1) - here * r[:, None], matrix.sum(0) - here * c[:, None]
    own = np.diag(matrix) - here * (right + left + self_pairs[:, None])
    gain -= _xlogx(own + right) + _xlogx(own + left) - 2 * _xlogx(own)
    gain += _xlogx(own + right + left + self_pairs[:, None]) - _xlogx(own)
    gain -= _xlogx(rows + r[:, None]) - _xlogx(rows) + _xlogx(columns + c[:, None]) - _xlogx(columns)
    gain[:, 0] = -np.inf
    best = gain.argmax(1)
    return np.where(gain[at, best] > gain[at, now] + 1e-6, best, now)


def _lists(batch: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    value = batch.column(batch.schema.get_field_index(name))[i].values
    return np.zeros(0, np.int64) if value is None else value.to_numpy(zero_copy_only=False)


def _moves(classes: np.ndarray, matrix: np.ndarray, turn: int) -> Callable:
    count = len(matrix)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, to = [], []
            for i, unit in enumerate(batch.column(0).to_pylist()):
                if classes[unit] == 0 or crc32(b"%d:%d" % (unit, turn // 2)) % 2 != turn % 2:
                    continue
                r, rn, left, ln = (_lists(batch, i, c) for c in ("r", "rn", "l", "ln"))
                own = float(rn[r == unit].sum())
                right = np.bincount(classes[r], weights=np.where(r == unit, 0, rn), minlength=count)
                before = np.bincount(classes[left], weights=np.where(left == unit, 0, ln), minlength=count)
                best = best_class(matrix, int(classes[unit]), right, before, own)
                if best != classes[unit]:
                    units.append(unit)
                    to.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), pa.array(to, pa.int32())], names=["unit", "to"])

    return work


def _class_pairs(classes: np.ndarray, count: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count * count, dtype=np.int64)
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy() for i in range(3))
            np.add.at(total, classes[a] * count + classes[b], n)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["cell", "n"])

    return work


def _matrix(pairs: DataFrame, classes: np.ndarray, count: int) -> np.ndarray:
    cells = pairs.select("a", "b", "n").mapInArrow(_class_pairs(classes, count), "cell int, n long")
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(count * count, dtype=np.int64)
    for r in rows:  # at most count * count rows
        out[r["cell"]] = r["n"]
    return out.reshape(count, count)


def exchange(pairs: DataFrame, units: int, classes: int, rounds: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit and the class matrix. The last unit is the end, alone in class 0.

    ``order`` lists the units from frequent to rare; they start dealt out in turn. When moves that were each found alone
    lower the likelihood together, a half, a quarter and an eighth of them are tried.
    """
    now = np.zeros(units, dtype=np.int64)
    now[order] = 1 + np.arange(len(order)) % (classes - 1)
    now[units - 1] = 0
    near = _neighbours(pairs)
    matrix = _matrix(pairs, now, classes)
    for turn in range(rounds):
        moved = near.mapInArrow(_moves(now, matrix, turn), "unit int, to int").collect()  # at most one row per unit
        for part in (1, 2, 4, 8):
            chosen = [r for r in moved if crc32(b"%d/%d" % (turn, r["unit"])) % part == 0]
            if not chosen:
                break
            trial = now.copy()
            for r in chosen:
                trial[r["unit"]] = r["to"]
            changed = _matrix(pairs, trial, classes)
            if likelihood(changed) > likelihood(matrix):
                now, matrix = trial, changed
                break
    return now, matrix


def _count_near(frequent, wanted, classes: np.ndarray, count: int) -> Callable:
    """Per rarer word that may reach the floor its neighbours by class: successors, predecessors, and itself once for a pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, known = {w: i for i, w in enumerate(frequent.value)}, filter_of(wanted)
        cells, numbers = 2 * count + 1, _Numbers()
        head, tails = classes[: len(first)], classes[len(first) : len(first) + TAILS]
        held: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)

        def out() -> Iterator[pa.RecordBatch]:
            word, cell = keys // cells, keys % cells
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            bounds = np.append(starts, len(keys))
            for i in range(0, len(starts), 50_000):
                own = bounds[i : i + 50_001]
                part = slice(own[0], own[-1])
                places = pa.array((own - own[0]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([numbers.words[w] for w in word[own[:-1]]], pa.binary()),
                     pa.ListArray.from_arrays(places, pa.array(cell[part].astype(np.int16))),
                     pa.ListArray.from_arrays(places, pa.array(counts[part].astype(np.int32)))],
                    names=["word", "cells", "counts"],
                )

        for batch in batches:
            texts = raw_texts(batch.column(0))
            for part in _slices(texts):
                found = _coded(texts[part])
                words = _listed(found.words)
                own = np.fromiter(map(first.get, words, repeat(-1)), np.int64, len(words))
                of = np.where(own < 0, tails[_tails(found.words)], head[own] if len(head) else 0)
                asked = np.flatnonzero((own < 0) & known.has(word_hashes(found.words)))
                number = np.full(len(words), -1, dtype=np.int64)
                number[asked] = [numbers[words[i]] for i in asked.tolist()]
                row, near = (_with_ends(x[found.ids], found.lengths, end) for x, end in ((number, -1), (of, classes[-1])))
                at = np.flatnonzero(row >= 0)
                word, same_after, same_before = row[at], row[at + 1] == row[at], row[at - 1] == row[at]
                base = word * cells
                held.append(base + np.where(same_after, 2 * count, near[at + 1]))
                held.append((base + count + near[at - 1])[~same_before])
                size += 2 * len(at)
                if size >= HELD_PAIRS or len(numbers) >= HELD_NEAR:
                    keys, counts = merged()
                    yield from out()
                    numbers, held, size = _Numbers(), [], 0
        keys, counts = merged()
        yield from out()

    return work


def _choose(matrix: np.ndarray, tails: np.ndarray) -> Callable:
    """Best class of each word of ``FLOOR`` or more, -1 for the others, from rows in the order of the words.

    The neighbours of a word are summed as they come, also across batches.
    """
    count = len(matrix)
    cells = 2 * count + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_n, last_near = None, 0, np.zeros(cells, np.int64)  # the word that may go on in the next batch

        def out(words: list[bytes], n: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
            to, enough = np.full(len(words), -1), np.flatnonzero(n >= FLOOR)
            for i in range(0, len(enough), 500):
                part = enough[i : i + 500]
                x = near[part]
                now = tails[_tails_of([words[w] for w in part])]
                to[part] = best_classes(matrix, now, x[:, :count], x[:, count:-1], x[:, -1])
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n), pa.array(to, pa.int32())], names=["word", "n", "class"])

        for whole in batches:
            for start in range(0, whole.num_rows, 10_000):
                batch = whole.slice(start, 10_000)
                column = batch.column(0)
                starts = np.concatenate([[True], pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)])
                run = np.cumsum(starts) - 1
                words = _listed(column.take(pa.array(np.flatnonzero(starts))))
                n = np.zeros(len(words), np.int64)
                np.add.at(n, run, batch.column(1).fill_null(0).to_numpy(zero_copy_only=False))
                lengths = batch.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                at = np.repeat(run, lengths) * cells + batch.column(2).flatten().to_numpy(zero_copy_only=False)
                near = np.bincount(at, weights=batch.column(3).flatten().to_numpy(zero_copy_only=False), minlength=len(words) * cells)
                near = near.reshape(-1, cells)
                if words[0] == last:
                    n[0] += last_n
                    near[0] += last_near
                elif last is not None:
                    yield out([last], np.array([last_n]), last_near[None])
                yield out(words[:-1], n[:-1], near[:-1])
                last, last_n, last_near = words[-1], int(n[-1]), near[-1]
        if last is not None:
            yield out([last], np.array([last_n]), last_near[None])

    return work


def rarer_words(rare: DataFrame, texts: DataFrame, frequent, classes: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """(word, n, class) of the ``rare`` words, which are no units of their own; class -1 under the floor."""
    count = len(matrix)
    wanted = made_filter(rare.where(F.col("n") >= FLOOR).select("word"))
    near = texts.mapInArrow(_count_near(frequent, wanted, classes, count), "word binary, cells array<smallint>, counts array<int>")
    none = F.lit(None)
    both = rare.select("word", "n", none.cast("array<smallint>").alias("cells"), none.cast("array<int>").alias("counts")).unionByName(
        near.select("word", none.cast("long").alias("n"), "cells", "counts"))
    # A word that the filter let pass by mistake is rare too, so every word has its count.
    ordered = both.repartition("word").sortWithinPartitions("word")
    return stage(ordered.mapInArrow(_choose(matrix, classes[-1 - TAILS : -1]), "word binary, n long, class int"), "rarer-words")


def _lookup_floor(table: DataFrame) -> int:
    """The least count from which on there are at most ``LOOKUP_WORDS`` words."""
    most = 1_000_000
    rows = table.groupBy(F.least("n", F.lit(most)).alias("n")).agg(F.count("*").alias("words")).collect()  # at most ``most`` rows
    total, floor = 0, most + 1
    for r in sorted(rows, key=lambda r: -r["n"]):
        total += r["words"]
        if total > LOOKUP_WORDS:
            break
        floor = r["n"]
    return floor


@dataclass
class ClassModel:
    """What scoring needs: bounded tables, and the count table for the rarer words."""

    tokens: int  # N
    types: int  # V
    words: list[bytes]  # looked up in the task, the frequent ones first
    counts: np.ndarray
    classes: np.ndarray  # of each looked up word
    own: np.ndarray  # whether that is its own, not its tail's
    tails: np.ndarray  # class of each tail
    steps: np.ndarray  # log10 of class transitions
    class_log: np.ndarray  # log10 of the tokens in each class
    discount: float  # of the words under the floor
    unknown_log: np.ndarray  # of each tail: log10 of the mass of unknown words, in tokens
    table: DataFrame  # (word, n) of all words
    rarer: DataFrame | None  # (word, n, class) of the words that are no units of their own


class _Paths:
    """Class of every token of a text where the task knows it; the other words are numbered and asked for.

    With ``own``, a filter that lets all other words with a class of their own pass, no word that it holds back is asked for:
    its class is that of its tail. Without it all other words are.
    """

    def __init__(self, words: list[bytes], classes: np.ndarray, own: Filter | None = None, tails: np.ndarray | None = None):
        self.get = {w: i for i, w in enumerate(words)}.get
        self.classes, self.own, self.tails = classes, own, tails

    def of(self, texts: list[bytes]) -> _Nodes:
        """The nodes of several texts at once."""
        found = _coded(texts)
        number = np.fromiter(map(self.get, _listed(found.words), repeat(-1)), np.int64, len(found.words))
        node = np.where(number < 0, -1, self.classes[number] if len(self.classes) else 0)
        if self.own is not None:
            held = np.flatnonzero((number < 0) & ~self.own.has(word_hashes(found.words)))
            node[held] = self.tails[_tails(found.words)[held]]
        at, path = number[found.ids], node[found.ids]
        text = np.repeat(np.arange(len(texts)), found.lengths)
        ask = np.flatnonzero(path < 0)
        different, inverse = np.unique(text[ask] * max(len(found.words), 1) + found.ids[ask], return_inverse=True)
        of_text, word = np.divmod(different, max(len(found.words), 1))
        first = np.searchsorted(of_text, np.arange(len(texts) + 1))
        path[ask] = first[text[ask]] - inverse - 1
        bounds = np.concatenate([[0], np.cumsum(found.lengths + 2)])
        nodes = np.zeros(bounds[-1], dtype=np.int64)  # ends have class 0
        nodes[np.arange(len(at)) + 2 * text + 1] = path
        known = at >= 0
        asked = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), found.words.take(pa.array(word)))
        return _Nodes(at[known], text[known], nodes, bounds, found.lengths, asked)


class _Nodes(NamedTuple):
    """Numbers of the known words and their texts; the paths of the texts one after another; what to ask for in each.

    A node is a class, or -1 - number of the word to ask for in its text.
    """

    hit: np.ndarray
    text: np.ndarray
    path: np.ndarray
    bounds: np.ndarray
    lengths: np.ndarray
    asked: pa.ListArray

    def known_steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts and classes of the steps between known classes."""
        both = (self.path[:-1] >= 0) & (self.path[1:] >= 0)
        both[self.bounds[1:-1] - 1] = False  # from one text to the next
        at = np.flatnonzero(both)
        return np.searchsorted(self.bounds, at, side="right") - 1, self.path[at], self.path[at + 1]

    def runs(self) -> pa.ListArray:
        """Nodes to ask for and those beside them, per text. Two classes side by side are no step, or one of ``known_steps``."""
        ask = self.path < 0  # never an end, so no text has a neighbour in the next
        near = ask.copy()
        near[1:] |= ask[:-1]
        near[:-1] |= ask[1:]
        at = np.flatnonzero(near)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, self.bounds).astype(np.int32)), pa.array(self.path[at].astype(np.int32)))


def _slices(texts: list[bytes]) -> Iterator[slice]:
    """Slices of about ``SLICE`` bytes of text."""
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= SLICE:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _asked_steps(runs: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the steps that ``known_steps`` left out; ``told`` has the class of each word asked for."""
    path = np.where(runs >= 0, runs, told[np.where(runs >= 0, 0, -1 - runs)])
    either = (runs[:-1] < 0) | (runs[1:] < 0)
    return path[:-1][either], path[1:][either]


def _answers(local: DataFrame, rarer: DataFrame) -> DataFrame:
    """``local`` and what the table of rarer words tells of its lm_words: their places, counts and classes."""
    asked = local.where(F.size("lm_words") > 0).select("lm_row", F.posexplode("lm_words").alias("at", "word"))
    found = asked.join(rarer, "word").groupBy("lm_row").agg(F.collect_list(F.struct("at", "n", "class")).alias("x"))
    found = found.select("lm_row", F.col("x.at").alias("lm_at"), F.col("x.n").alias("lm_counts"), F.col("x.class").alias("lm_classes"))
    return local.join(found, "lm_row", "left")


def _told(batch: pa.RecordBatch, i: int, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word that row ``i`` asks for: its count, 0 if unknown; whether it has a class of its own; its class; its tail."""
    words = batch.column(batch.schema.get_field_index("lm_words"))[i].as_py() or []
    tail = _tails_of(words)
    n, to = np.zeros(len(words), np.int64), np.full(len(words), -1)
    at = _lists(batch, i, "lm_at")
    n[at], to[at] = _lists(batch, i, "lm_counts"), _lists(batch, i, "lm_classes")
    return n, to >= 0, np.where(to >= 0, to, tails[tail]), tail


def _first_steps(known, own, tails: np.ndarray, count: int) -> Callable:
    """Per text what to ask for, if anything; at the end of the task a row with the steps that need no answer."""
    names = ["lm_row", "lm_words", "lm_runs", "lm_steps"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, total = _Paths(*known.value, filter_of(own), tails), np.zeros(count * count, np.int64)
        kinds = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for part in _slices(texts):
                found = paths.of(texts[part])
                _, a, b = found.known_steps()
                total += np.bincount(a * count + b, minlength=count * count)
                some = pa.array(np.flatnonzero(found.asked.value_lengths().to_numpy()))
                columns = [batch.column(0)[part.start : part.stop].take(some), found.asked.take(some), found.runs().take(some)]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(some), kinds[3])], names=names)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, k) for k in kinds[:3]], pa.array([total], kinds[3])], names=names)

    return work


def _all_steps(tails: np.ndarray, count: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count * count, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                steps = _lists(batch, i, "lm_steps")
                if len(steps):
                    total += steps
                    continue
                a, b = _asked_steps(_lists(batch, i, "lm_runs"), _told(batch, i, tails)[2])
                total += np.bincount(a * count + b, minlength=count * count)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["cell", "n"])

    return work


def class_steps(texts: DataFrame, words: list[bytes], classes: np.ndarray, rarer: DataFrame, tails: np.ndarray, count: int) -> np.ndarray:
    """How often each class follows each, by the classes of all words. ``texts`` has one binary column, ``rarer`` all words
    with a class that are not among ``words``. What is in neither has the class of its tail."""
    known = texts.sparkSession.sparkContext.broadcast((words, classes))
    rows = texts.select(F.monotonically_increasing_id(), F.col(f"`{texts.columns[0]}`"))
    own = made_filter(rarer.select("word"))
    local = rows.mapInArrow(_first_steps(known, own, tails, count), "lm_row long, lm_words array<binary>, lm_runs array<int>, lm_steps array<long>")
    cells = _answers(stage(local, "steps"), rarer).mapInArrow(_all_steps(tails, count), "cell int, n long")
    out = np.zeros(count * count, dtype=np.int64)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most count * count rows
        out[r["cell"]] = r["n"]
    return out.reshape(count, count)


def fit(texts: DataFrame, text: str = "text", classes: int = 64, rounds: int = 8) -> ClassModel:
    """Count, cluster and smooth. An empty table gives a model in which nothing is known."""
    table = word_counts(texts, text)
    totals = table.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("n1"),
                       F.count_if(F.col("n") == 2).alias("n2")).first()
    tokens, types = int(totals["n"] or 0), int(totals["v"])
    if not tokens:
        none = np.zeros(0, np.int64)
        return ClassModel(0, 0, [], none, none, none > 0, np.zeros(TAILS, np.int64), np.zeros((2, 2)), np.zeros(2), 0.5,
                          np.zeros(TAILS), table, None)
    discount = totals["n1"] / (totals["n1"] + 2 * totals["n2"]) if totals["n1"] and totals["n2"] else 0.5
    is_end = F.col("word") == F.lit(END)
    # No more than 1 / UNIT_SHARE words can have that share of the tokens.
    head = table.where(~is_end & (F.col("n") >= F.lit(UNIT_SHARE * tokens))).toArrow()
    words, counts = head.column(0).to_pylist(), head.column(1).to_numpy()
    by_count = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    words, counts = [words[i] for i in by_count], counts[by_count]
    frequent = len(words)
    units = frequent + TAILS + 1

    tail = F.pmod(F.crc32(F.when(F.length("word") < 2, F.col("word")).otherwise(F.expr("substring(word, -2, 2)"))), F.lit(TAILS))
    rare = table.where(~is_end & (F.col("n") < F.lit(UNIT_SHARE * tokens)))
    unit_tokens = np.concatenate([counts, np.zeros(TAILS + 1, np.int64)])
    for r in rare.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n")).collect():  # TAILS rows
        unit_tokens[frequent + r["tail"]] = r["n"]
    unit_tokens[-1] = table.where(is_end).first()["n"]

    raw = texts.select(F.col(f"`{text}`").cast("binary"))
    own = texts.sparkSession.sparkContext.broadcast(words)
    pairs = raw.mapInArrow(_count_pairs(own), "a int, b int, n long")
    pairs = stage(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "unit-pairs")
    order = np.argsort(-unit_tokens[:-1], kind="stable")
    of_unit, matrix = exchange(pairs, units, classes, rounds, order)

    tails = of_unit[frequent:-1]
    rarer = rarer_words(rare, raw, own, of_unit, matrix)
    # Tokens of the classes: units of their own, rarer words with a class, and what is under the floor by its tail.
    total = np.bincount(of_unit[:frequent], weights=counts, minlength=classes)
    total[0] += unit_tokens[-1]
    tail_types = np.zeros(TAILS)
    under = F.col("class") < 0
    sums = rarer.groupBy("class", F.when(under, tail).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r in sums.collect():  # at most TAILS + classes rows
        if r["class"] < 0:
            total[tails[r["tail"]]] += r["n"]
            tail_types[r["tail"]] = r["v"]
        else:
            total[r["class"]] += r["n"]
    floor = _lookup_floor(table)
    known = rarer.where(F.col("n") >= floor).toArrow()  # at most LOOKUP_WORDS rows
    more, to = known.column(0).to_pylist(), known.column(2).to_numpy().astype(np.int64)
    by_tail = tails[_tails_of(more)]
    words, counts = words + more, np.concatenate([counts, known.column(1).to_numpy()])
    of_word = np.concatenate([of_unit[:frequent], np.where(to >= 0, to, by_tail)])
    has_own = np.concatenate([np.ones(frequent, bool), to >= 0])
    matrix = class_steps(raw, words, of_word, rarer.where(~under & (F.col("n") < floor)), tails, classes)

    after = matrix.sum(1, keepdims=True)
    kinds = (matrix > 0).sum(1, keepdims=True)
    trust = after / np.maximum(after + kinds, 1)
    plain = (matrix.sum(0) + 1) / (matrix.sum() + classes)
    steps = np.log10(trust * matrix / np.maximum(after, 1) + (1 - trust) * plain)
    unknown = np.log10(np.maximum(discount * tail_types, 1 / (tokens + types + 1)))
    return ClassModel(tokens, types, words, counts, of_word, has_own, tails, steps, np.log10(np.maximum(total, 1)), discount, unknown,
                      table, rarer)


def _score(model, constants: dict, text_column: int) -> Callable:
    """Per text: what the task can tell, and the words whose counts and classes it has to ask for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, classes, own = model.value
        paths = _Paths(words, classes)
        steps, class_log, scale = constants["steps"], constants["class_log"], np.log10(constants["tokens"] + constants["types"] + 1)
        base_log = np.log10(counts + 1) - scale
        word_log = np.log10(np.where(own, counts, counts - constants["discount"])) - class_log[classes]
        for whole in batches:
            texts = raw_texts(whole.column(text_column))
            for part in _slices(texts):
                found, count = paths.of(texts[part]), part.stop - part.start
                text, a, b = found.known_steps()
                known = np.bincount(found.text, minlength=count) + (1 if constants["ends"] else 0)
                base = np.bincount(found.text, weights=base_log[found.hit], minlength=count) + (np.log10(constants["ends"] + 1) - scale)
                emitted = np.bincount(found.text, weights=word_log[found.hit], minlength=count)
                score = emitted + np.bincount(text, weights=steps[a, b], minlength=count).astype(np.float64)
                added = [pa.array(found.lengths + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score), found.asked,
                         found.runs()]
                keep = [i for i in range(whole.num_columns) if i != text_column]
                yield pa.RecordBatch.from_arrays(
                    [*[whole.column(i)[part.start : part.stop] for i in keep], *added],
                    names=[*[whole.schema.names[i] for i in keep], "lm_n", "lm_known", "lm_base", "lm_score", "lm_words", "lm_runs"],
                )

    return work


def _finish(constants: dict) -> Callable:
    """Adds to each text what was asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, class_log, tails = constants["steps"], constants["class_log"], constants["tails"]
        scale = np.log10(constants["tokens"] + constants["types"] + 1)
        for batch in batches:
            names = batch.schema.names
            known, base, score = (batch.column(names.index(c)).to_pylist() for c in ("lm_known", "lm_base", "lm_score"))
            for i in range(batch.num_rows):
                runs = _lists(batch, i, "lm_runs")
                if not len(runs):
                    continue
                n, own, to, tail = _told(batch, i, tails)
                each = -1 - runs[runs < 0]
                a, b = _asked_steps(runs, to)
                held = np.maximum(np.where(own, n, n - constants["discount"]), 1e-300)
                emitted = np.where(n > 0, np.log10(held), constants["unknown_log"][tail]) - class_log[to]
                known[i] += int((n[each] > 0).sum())
                base[i] += float((np.log10(n + 1) - scale)[each].sum())
                score[i] += float(steps[a, b].sum() + emitted[each].sum())
            told = {"lm_known": pa.array(known, pa.int64()), "lm_base": pa.array(base, pa.float64()), "lm_score": pa.array(score, pa.float64())}
            kept = [c for c in names if c not in ("lm_row", "lm_words", "lm_runs", "lm_at", "lm_counts", "lm_classes")]
            yield pa.RecordBatch.from_arrays([told.get(c, batch.column(names.index(c))) for c in kept], names=kept)

    return work


def score(docs: DataFrame, model: ClassModel, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A null text is empty: its only token is the end. Without training tokens every probability is 1, so the scores are
    0. Rows are scored each by itself, so repeated rows get equal scores.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    docs = docs.drop(*[c for c in added if c != text])
    others = [c for c in docs.columns if c != text]
    spark = docs.sparkSession
    ends = model.table.where(F.col("word") == F.lit(END)).first()
    constants = {
        "steps": model.steps, "class_log": model.class_log, "tails": model.tails, "unknown_log": model.unknown_log,
        "tokens": model.tokens, "types": model.types, "discount": model.discount, "ends": ends["n"] if ends else 0,
    }
    lookup = spark.sparkContext.broadcast((model.words, model.counts, model.classes, model.own))
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.monotonically_increasing_id().alias("lm_row"),
                       F.col(f"`{text}`").cast("binary").alias("lm_text"))
    kept = ", ".join(f"`{c}` {k}" for c, k in docs.select(*[F.col(f"`{c}`") for c in others]).dtypes)
    kept += ", " if kept else ""
    told = f"{kept}lm_n long, lm_known long, lm_base double, lm_score double"
    local = rows.mapInArrow(
        _score(lookup, constants, len(others) + 1),
        f"{kept}lm_row long, lm_n long, lm_known long, lm_base double, lm_score double, lm_words array<binary>, lm_runs array<int>",
    )
    if model.rarer is None:
        joined = local
    else:
        joined = _answers(stage(local, "scored"), model.rarer).select(
            *[F.col(f"`{c}`") for c in others], "lm_n", "lm_known", "lm_base", "lm_score", "lm_words", "lm_runs", "lm_at", "lm_counts",
            "lm_classes",
        ).mapInArrow(_finish(constants), told)
    zero = F.lit(0.0)
    whole, base = (F.col("lm_score"), F.col("lm_base")) if model.tokens else (zero, zero)
    return joined.select(
        *[F.col(f"`{c}`") for c in others], F.col("lm_n").alias("n_tokens"), F.col("lm_known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), whole.alias("score"),
        F.pow(F.lit(10.0), -whole / F.col("lm_n")).alias("perplexity"),
    )


def in_part(key: str, parts: int, part: int = 2) -> Column:
    """True for rows whose crc32 of the key as text leaves ``part``; a null key counts as not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))
