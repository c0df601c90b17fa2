"""Word vectors by skip-gram with hierarchical softmax, trained part by part; the driver holds no word.

1. Texts are dealt to parts of bounded size. Each part gets the rows of its own words only.
2. The Huffman tree comes from the histogram of the word counts: words of one count are a group, and so are the inner nodes that
   pairs of them make. The node of a word is its group's first node plus its rank among the words of that count.
3. A part trains its words and the inner nodes above them; the parts that changed a node are averaged by the node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.parts import PART, dealt, packed, part_numbers, places, side_by_side, unpacked
from corpusmill.operators.ranks import hash_rank
from corpusmill.operators.rows import explode_values
from corpusmill.sources.staging import free_shuffles, stage

BLOCK = 64  # positions whose changes are added up before they count, at most
REPEATS = 1.2  # positions of a block for each different word in it; more would add up the same change too often
SLAB = 1 << 15  # positions whose pairs and paths are made at once
WORDS = 1 << 15  # words whose paths are found at once
ROWS = 1 << 14  # rows of a batch that a part returns
SENTENCE = 1000  # known words of the longest sentence; longer texts are cut
RATE = 0.025  # learning rate at the start
LEAST_RATE = 1e-4  # share of it that is left at the end
STEEP = 6.0  # beyond this a node's answer is taken as certain


# --- the tree --------------------------------------------------------------------------------


class Tree(NamedTuple):
    """A Huffman tree over groups of equal weight: node ``start[g] + i`` is the i-th of group g.

    The first ``pairs[g]`` nodes of a group are paired with each other, under the nodes of group ``parent[g]``. The few others are in
    ``odd`` (rising), with the node above each and its side.
    """

    start: np.ndarray
    pairs: np.ndarray
    parent: np.ndarray
    odd: np.ndarray
    above: np.ndarray
    side: np.ndarray
    root: int


def huffman(weights: list[int], sizes: list[int]) -> Tree:
    """The tree of ``sizes[g]`` leaves of weight ``weights[g]`` for each g; leaves come first among the groups."""
    size, live = list(sizes), list(sizes)
    pairs, parent = [0] * len(size), [0] * len(size)
    odd: list[tuple[int, int, int, int]] = []
    heap = [(w, g) for g, w in enumerate(weights)]
    heapify(heap)

    def grown(weight: int, nodes: int) -> int:
        for column, value in ((size, nodes), (live, nodes), (pairs, 0), (parent, 0)):
            column.append(value)
        heappush(heap, (weight, len(size) - 1))
        return len(size) - 1

    root = (0, 0)
    while heap:
        weight, g = heappop(heap)
        count = live[g]
        if count >= 2:
            pairs[g] = count // 2 * 2
            parent[g] = grown(2 * weight, count // 2)
        if count % 2:
            while heap and not live[heap[0][1]]:
                heappop(heap)
            if not heap:
                root = (g, count - 1)
                break
            other, h = heap[0]
            live[h] -= 1
            new = grown(weight + other, 1)
            odd += [(g, count - 1, new, 0), (h, live[h], new, 1)]
    start = np.cumsum([0, *size[:-1]]).astype(np.int64)
    nodes = np.array([start[g] + i for g, i, _, _ in odd], np.int64)
    order = np.argsort(nodes)
    above, side = (np.array([x for x in column], np.int64)[order] for column in (
        [start[new] for _, _, new, _ in odd], [s for _, _, _, s in odd]))
    return Tree(start, np.array(pairs), np.array(parent), nodes[order], above, side, int(start[root[0]] + root[1]))


def tree_paths(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner nodes above each node up to the root, -1 past it, and the side taken below each."""
    found, sides = [], []
    at = nodes.copy()
    while (below := at != tree.root).any():
        group = np.searchsorted(tree.start, at, side="right") - 1
        i = at - tree.start[group]
        paired = i < tree.pairs[group]
        up, side = tree.start[tree.parent[group]] + i // 2, i % 2
        if (alone := below & ~paired).any():
            where = np.searchsorted(tree.odd, at[alone])
            up[alone], side[alone] = tree.above[where], tree.side[where]
        found.append(np.where(below, up, -1))
        sides.append(side)
        at = np.where(below, up, at)
    if not found:
        return np.zeros((len(nodes), 0), np.int64), np.zeros((len(nodes), 0), np.int64)
    return np.column_stack(found), np.column_stack(sides)


# --- one part --------------------------------------------------------------------------------


def first_vectors(nodes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Small random vectors that depend on node and seed only, so every part begins with the same ones."""
    x = nodes.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)
    x += np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(11)).astype(np.float64) / 2.0**53 - 0.5) / size).astype(np.float32)


def _block_ends(words: np.ndarray) -> list[int]:
    """Where blocks end: each goes as far as enough of its words are different."""
    order = np.argsort(words, kind="stable")
    same = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    before = np.full(len(words), -1, np.int32)  # the place of the same word before
    before[order[same + 1]] = order[same]
    ends, start, different = [], 0, 0
    for i, last in enumerate(chain.from_iterable(before[i : i + SLAB].tolist() for i in range(0, len(before), SLAB))):
        different += last < start
        if i + 1 - start > REPEATS * different:
            ends.append(i)
            start, different = i, 1
        elif i + 1 - start == BLOCK:
            ends.append(i + 1)
            start, different = i + 1, 0
    return ends + [len(words)] if start < len(words) else ends


def skip_gram(
    words: np.ndarray, sentence: np.ndarray, above: np.ndarray, sides: np.ndarray, vectors: np.ndarray, inner: np.ndarray,
    window: int, rate: Callable[[int], float], rng: np.random.Generator,
) -> np.ndarray:
    """Train ``vectors`` and ``inner`` in place over a row of words; True for each word that was trained.

    ``above`` has the row of ``inner`` for each step of a word's path; its last row stands for none, with a side of one half.
    """
    n = len(words)
    steps = np.r_[np.arange(-window, 0), np.arange(1, window + 1)]
    reach = (window - rng.integers(0, window, n)).astype(np.int32)
    deep = (above < len(inner) - 1).sum(1)
    trained = np.zeros(len(vectors), bool)
    ends = np.array(_block_ends(words), np.int64)
    # Per word and node of a block, one number has how many pairs go there and how many of them to side 0.
    scale = 1 << (2 * window * BLOCK).bit_length()
    kind = np.float32 if scale <= 1 << 12 else np.float64
    word_at, node_at = np.zeros(len(vectors), np.int64), np.zeros(len(inner), np.int64)
    numbers = np.arange(BLOCK * max(1, above.shape[1]) + 2 * window + 1)
    done = 0
    while done < len(ends):
        first = int(ends[done - 1]) if done else 0
        last = max(done + 1, int(np.searchsorted(ends, first + SLAB, side="right")))
        slab, done = ends[done:last], last
        here = np.arange(first, slab[-1])
        own = words[here]
        near = here[:, None] + steps
        inside = np.clip(near, 0, n - 1)
        use = (near == inside) & (np.abs(steps) <= reach[here, None]) & (sentence[inside] == sentence[here, None]) & (deep[own] > 0)[:, None]
        center, step = np.nonzero(use)
        beside = first + center + steps[step]
        center += first
        trained[words[beside]] = True
        on_path = np.arange(above.shape[1]) < deep[own][:, None]
        path = above[own][on_path]
        code = (1 + scale * (1 - sides[own][on_path])).astype(kind)
        position = np.repeat(here, deep[own])
        cuts = np.append(0, slab - first)
        of_pairs, of_paths = (np.append(0, np.cumsum(x))[cuts].tolist() for x in (use.sum(1), deep[own]))
        start = first
        for b, end in enumerate(slab.tolist()):
            pairs, nodes = slice(of_pairs[b], of_pairs[b + 1]), slice(of_paths[b], of_paths[b + 1])
            if pairs.start < pairs.stop:
                low = max(start - window, 0)
                _train_block(
                    words[low : end + window], beside[pairs] - low, center[pairs] - start, path[nodes], position[nodes] - start, code[nodes],
                    end - start, scale, kind, rate(start), vectors, inner, word_at, node_at, numbers)
            start = end
    return trained


def _different(values: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, and the place of each value among them; ``at`` has room for every value."""
    own = numbers[: len(values)]
    at[values] = own
    different = values[at[values] == own]
    at[different] = numbers[: len(different)]
    return different, at[values]


def _train_block(words, beside, center, path, position, code, size, scale, kind, rate, vectors, inner, word_at, node_at, numbers) -> None:
    """One product has every answer of the block; the changes of all its pairs are added up by word and node."""
    words, place = _different(words, word_at, numbers)
    nodes, node = _different(path, node_at, numbers)
    times = np.bincount(place[beside] * size + center, minlength=len(words) * size).astype(kind).reshape(-1, size)
    codes = np.zeros(size * len(nodes), kind)
    codes[position * len(nodes) + node] = code
    pairs = times @ codes.reshape(size, -1)
    change = np.floor(pairs * (1 / scale))  # pairs that go to side 0
    pairs -= scale * change
    x, y = vectors.take(words, 0), inner.take(nodes, 0)
    told = x @ y.T
    answer = np.negative(told)
    with np.errstate(over="ignore"):  # such an answer is certain
        np.exp(answer, out=answer)
    answer += 1
    change -= np.divide(pairs, answer, out=pairs)
    if told.max() >= STEEP or told.min() <= -STEEP:
        change[np.abs(told) >= STEEP] = 0
    change *= rate
    change = change.astype(np.float32, copy=False)
    below = change.T @ x
    x += change @ y
    y += below
    vectors[words], inner[nodes] = x, y


def _sentences(packs: pa.ChunkedArray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Known words of all texts in a row, by keys, so that the order does not hang on that of the shuffle; and each one's sentence."""
    words, lengths, keys = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for texts in unpacked(packs):
        found, length = places(texts.column(1), names)
        words.append(found.astype(np.int32, copy=False))
        lengths.append(length)
        keys.append(texts.column(0).to_numpy())
    words, lengths, order = np.concatenate(words), np.concatenate(lengths), np.argsort(np.concatenate(keys), kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    within = np.arange(len(words), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
    words = words[within + np.repeat(begin.astype(np.int32), lengths)]
    cuts = -(-lengths // SENTENCE)
    return words, np.repeat((np.cumsum(cuts) - cuts).astype(np.int32), lengths) + within // SENTENCE


def _paths(tree: Tree, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inner nodes above the leaves, the row among them of each step of a leaf's path, and the sides; the last row is none."""
    slices = [leaves[i : i + WORDS] for i in range(0, len(leaves), WORDS)]
    above = np.zeros(0, np.int64)
    deepest = 0
    for part in slices:
        up, _ = tree_paths(tree, part)
        above, deepest = np.union1d(above, up[up >= 0]), max(deepest, up.shape[1])
    rows, sides = np.full((len(leaves), deepest), len(above), np.int32), np.full((len(leaves), deepest), 0.5, np.float32)
    for i, part in enumerate(slices):
        up, side = tree_paths(tree, part)
        own = slice(i * WORDS, i * WORDS + len(part)), slice(0, up.shape[1])
        rows[own], sides[own] = np.where(up >= 0, np.searchsorted(above, up), len(above)), np.where(up >= 0, side, 0.5)
    return above, rows, sides


def _train_part(sent, size: int, window: int, numbers: list[int], total: int, turn: int, turns: int, seed: int) -> Callable:
    """Rows (part, node, word, vector, weight) of one part; inner nodes have no word and are sent only if a turn follows."""

    parts, place = len(numbers), {n: i for i, n in enumerate(numbers)}

    def work(key: tuple, texts: pa.Table, own: pa.Table) -> pa.Table:
        tree, part = sent.value, key[0].as_py()
        own = own.sort_by("node")
        nodes = own.column("node").to_numpy()
        known = own.column("word").is_valid().to_numpy()
        names = own.column("word").drop_null().combine_chunks()
        leaves = nodes[known]
        words, sentence = _sentences(texts.column("_pack"), names)
        above, rows, sides = _paths(tree, leaves)
        vectors = np.empty((len(leaves), size), np.float32)
        for i in range(0, len(leaves), WORDS):
            vectors[i : i + WORDS] = first_vectors(leaves[i : i + WORDS], size, seed)
        inner = np.zeros((len(above) + 1, size), np.float32)
        if turn:
            values = own.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            vectors = values[known].astype(np.float32)
            inner[np.searchsorted(above, nodes[~known])] = values[~known]

        def rate(done: int) -> float:
            return RATE * max(1 - (parts * done + turn * total) / (turns * total + 1), LEAST_RATE)

        trained = skip_gram(words, sentence, rows, sides, vectors, inner, window, rate, np.random.default_rng([seed & 0xFFFFFFFF, turn, place[part]]))
        weight = trained.astype(np.float32)
        found = [(leaves, names, vectors, weight)]
        if turn + 1 < turns:
            found.append((above, pa.nulls(len(above), pa.string()), inner[:-1], np.ones(len(above), np.float32)))
        kinds = pa.schema([(PART, pa.int32()), ("node", pa.int64()), ("word", pa.string()), ("vector", pa.list_(pa.float32())), ("weight", pa.float32())])
        batches = []
        for out_nodes, out_names, rows_, weights in found:
            for i in range(0, len(out_nodes), ROWS):
                x = rows_[i : i + ROWS]
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * size, pa.int32()), pa.array(x.ravel(), pa.float32()))
                batches.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), part), pa.int32()), pa.array(out_nodes[i : i + ROWS], pa.int64()), out_names.slice(i, ROWS), values,
                     pa.array(weights[i : i + ROWS], pa.float32())], schema=kinds))
        return pa.Table.from_batches(batches, kinds)

    return work


def _averaged(size: int) -> Callable:
    """One row for each run of rows with the same node: the mean of the trained ones, else the vector that all began with."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # node, word, sum, weight, vector at the start

        def out(nodes: list, words: list, sums: np.ndarray, weights: np.ndarray, began: np.ndarray) -> pa.RecordBatch:
            mean = np.where(weights[:, None] > 0, sums / np.maximum(weights, 1)[:, None], began)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1) * size, pa.int32()), pa.array(mean.ravel().astype(np.float32), pa.float32()))
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(words, pa.string()), values], names=["node", "word", "vector"])

        for batch in batches:
            if not batch.num_rows:
                continue
            node, words = batch.column(0).to_numpy(), batch.column(1)
            x = batch.column(2).flatten().to_numpy().reshape(-1, size).astype(float)
            weight = batch.column(3).to_numpy().astype(float)
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            nodes, names = node[first].tolist(), words.take(pa.array(first)).to_pylist()
            sums, weights = np.add.reduceat(x * weight[:, None], first, axis=0), np.add.reduceat(weight, first)
            began = x[first]
            if last is not None:
                if last[0] == nodes[0]:
                    sums[0] += last[2]
                    weights[0] += last[3]
                else:
                    yield out([last[0]], [last[1]], last[2][None], np.array([last[3]]), last[4][None])
            if len(nodes) > 1:
                yield out(nodes[:-1], names[:-1], sums[:-1], weights[:-1], began[:-1])
            last = nodes[-1], names[-1], sums[-1], weights[-1], began[-1]
        if last is not None:
            yield out([last[0]], [last[1]], last[2][None], np.array([last[3]]), last[4][None])

    return work


# --- the fit ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class WordVectors:
    """Fitted vectors as a stage table (word, vector ARRAY<FLOAT>)."""

    vectors: DataFrame
    size: int

    def getVectors(self) -> DataFrame:
        """(word, vector ARRAY<DOUBLE>)."""
        return self.vectors.select("word", F.col("vector").cast("array<double>").alias("vector"))

    def getVectorSize(self) -> int:
        return self.size


def fit_word_vectors(
    df: DataFrame, tokens: str, size: int, window: int, min_count: int, parts: int, iterations: int, seed: int, key: str = "unique_id"
) -> WordVectors:
    """Vectors of all words that occur ``min_count`` times or more. No such word is an error."""
    model = _fitted(df, tokens, size, window, min_count, parts, iterations, seed, key)
    free_shuffles(df.sparkSession)  # what the parts sent is several times the model
    return WordVectors(model.where(F.col("word").isNotNull()).select("word", "vector"), size)


def _fitted(df: DataFrame, tokens: str, size: int, window: int, min_count: int, parts: int, iterations: int, seed: int, key: str) -> DataFrame:
    """A stage table (node, word, vector) of all words, and of inner nodes without a word where turns follow."""
    spark = df.sparkSession
    numbers = part_numbers(spark, parts)
    by_key = [c for c in (key, tokens) if c in df.columns]
    texts = dealt(df, tokens, parts, key).select(PART, F.xxhash64(*by_key).alias("_order"), F.col(tokens).alias("_tokens"))
    in_parts = explode_values(texts, [PART], "_tokens", "word").groupBy(PART, "word").agg(F.count(F.lit(1)).alias("n"))
    in_parts = stage(in_parts, "part-words")
    counts = in_parts.groupBy("word").agg(F.sum("n").alias("cnt"))
    counts = stage(counts.where(F.col("cnt") >= F.lit(min_count)), "word-counts")
    # One row for each different count: fewer than the square root of twice the words.
    groups = sorted((r["cnt"], r["n"]) for r in counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("n")).collect())
    if not groups:
        raise ValueError(f"no word occurs {min_count} times")
    total = sum(c * n for c, n in groups)
    tree = huffman([c for c, _ in groups], [n for _, n in groups])
    sent = spark.sparkContext.broadcast(tree)
    begins = spark.createDataFrame([(c, int(s)) for (c, _), s in zip(groups, tree.start)], "cnt long, start long")
    ranked = hash_rank(counts, "word", ["cnt"], seed).join(F.broadcast(begins), "cnt")
    words = stage(ranked.select("word", (F.col("start") + F.col("hash_rank") - 1).alias("node")), "word-nodes")

    own = in_parts.join(words, "word").select(PART, "node", "word", F.lit(None).cast("array<float>").alias("vector"))
    texts = packed(texts, "_order", "_tokens")
    fields = f"{PART} int, node long, word string, vector array<float>, weight float"
    for turn in range(iterations):
        train = _train_part(sent, size, window, numbers, total, turn, iterations, seed)
        found = side_by_side(texts, own, parts).applyInArrow(train, fields)
        if turn + 1 < iterations:
            found = stage(found, "trained-parts")
        rows = found.select("node", "word", "vector", "weight").repartition("node").sortWithinPartitions("node", "weight", "vector")
        model = stage(rows.mapInArrow(_averaged(size), "node long, word string, vector array<float>"), "word-vectors")
        if turn + 1 < iterations:
            own = found.select(PART, "node").join(model, "node").select(PART, "node", "word", "vector")
    return model
