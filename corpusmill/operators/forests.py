"""Random forests that are grown and kept in parts, and scored at any number of their trees.

Values become places among at most 63 thresholds of their feature. Every tree draws its rows (Poisson) and the features of each node. Nodes
with more rows than one task takes are split by sums that all tasks make; the rows of a smaller node go to one task, which grows all
that is below it. The trees are a stage table and are scored in blocks; the driver holds the split nodes of the first kind only.
The first trees of a forest are a forest, so that a grid over the number of trees takes one forest and one scan.

Where most values are 0, a row keeps only the places of the others. Splits are then found from those and the counts of the nodes, with
the same trees, and a task takes as many rows as hold that many kept values.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.staging import scratch_path, stage

BINS = 64
ROWS = 1 << 19  # rows of a node that one task grows,
CELLS = 1 << 27  # and their values,
KEPT = 1 << 25  # or those that are kept of rows that are mostly 0
SPARSE = 8  # rows are kept so where less than one value of this many is not 0
ENTRIES = 1 << 22  # values that a task sorts at once
NODES = 1 << 21  # nodes that a task scores with
TOP_BYTES = 1 << 26  # sums of a task over nodes that are too large for one
DRAWN = np.cumsum([np.exp(-1) / float(f) for f in np.cumprod([1, *range(1, 15)], dtype=float)])
TREES = "tree int, start int, nodes long, feature binary, cut binary, left binary, counts binary"


class Binned(NamedTuple):
    """Rows as (row, label, bins), the thresholds of each feature, and what a forest has to know of them.

    ``kept`` is the number of values that are not 0 where only those are kept in ``bins``, else None.
    """

    rows: DataFrame
    thresholds: np.ndarray
    count: int
    classes: int
    features: str
    kept: int | None = None

    def rows_of(self, cells: int, kept: int) -> int:
        """How many rows have so many values, or so many that are kept."""
        if self.kept is None:
            return max(1, cells // max(1, len(self.thresholds)))
        return max(1, int(kept * self.count // max(1, self.kept)))


def find_thresholds(df: DataFrame, features: str) -> tuple[np.ndarray, int | None]:
    """Per feature the least value, 0 where it occurs, and 61 quantiles of the other values; the rest is infinite.

    Also the number of values that are not 0, if they are so few that only they should be kept.
    """
    v = df.select(F.unwrap_udt(features).alias("v"))
    size, n = v.agg(F.max(F.coalesce("v.size", F.size("v.values"))), F.count("*")).first()
    at = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    values = v.select(F.explode(F.arrays_zip(at.alias("i"), F.col("v.values").alias("x"))).alias("e")).select("e.i", "e.x").where("x <> 0")
    found = values.groupBy("i").agg(
        F.count("x").alias("n"), F.min("x").alias("least"),
        F.percentile_approx("x", [j / (BINS - 2) for j in range(1, BINS - 2)], 10000).alias("q"),
    ).collect()  # a row per feature
    out = np.full((size or 0, BINS - 1), np.inf)
    for r in found:
        own = np.unique([r["least"], *r["q"], *([0.0] if r["n"] < n else [])])
        out[r["i"], : len(own)] = own
    others = sum(r["n"] for r in found)
    return out, others if others * SPARSE < n * len(out) else None


def _bins(thresholds: np.ndarray, feature: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of thresholds of the feature below each value."""
    at = np.zeros(len(x), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        at += step * (thresholds[feature, at + step - 1] < x)
    return at.astype(np.uint8)


def _zeros(thresholds: np.ndarray) -> np.ndarray:
    """The place of 0 in each feature."""
    return _bins(thresholds, np.arange(len(thresholds)), np.zeros(len(thresholds)))


def _pair(size: int) -> np.dtype:
    """A kept value: its feature and its place."""
    return np.dtype([("feature", "<u2" if size <= 1 << 16 else "<u4"), ("bin", "u1")])


def _binned(thresholds: np.ndarray, sparse_rows: bool) -> Callable:
    """(row, label, vector) to (row, label, bins). Sparse rows keep the values that are not at the place of 0."""
    size = len(thresholds)
    zeros = _zeros(thresholds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, ENTRIES // max(1, size))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                v = batch.column(2)
                if v.null_count:
                    raise ValueError("a row has no features")
                kind, told, places, values = (v.field(i) for i in range(4))
                lengths = np.diff(values.offsets.to_numpy())
                x = values.flatten().to_numpy()
                sparse = kind.to_numpy() == 0
                widths = np.where(sparse, told.fill_null(size).to_numpy(), lengths)
                if (widths != size).any() or not np.isfinite(x).all():
                    raise ValueError(f"features must be {size} finite numbers")
                row = np.repeat(np.arange(len(v)), lengths)
                feature = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                feature[sparse[row]] = places.flatten().to_numpy()
                at = _bins(thresholds, feature, x)
                if sparse_rows:
                    other = np.flatnonzero(at != zeros[feature])
                    bins = np.empty(len(other), _pair(size))
                    bins["feature"], bins["bin"] = feature[other], at[other]
                    ends = np.searchsorted(other, np.r_[0, np.cumsum(lengths)]).astype(np.int64) * bins.itemsize
                else:
                    bins = np.tile(zeros, (len(v), 1))
                    bins[row, feature] = at
                    ends = np.arange(len(v) + 1, dtype=np.int64) * size
                kept = pa.Array.from_buffers(pa.large_binary(), len(v), [None, pa.py_buffer(ends), pa.py_buffer(bins.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept.cast(pa.binary())], names=["row", "label", "bins"])

    return work


def to_bins(df: DataFrame, features: str, thresholds: np.ndarray, name: str, sparse_rows: bool = False) -> DataFrame:
    """A stage table (row, label, bins) of ``df`` with these columns row and label."""
    rows = df.select("row", "label", F.unwrap_udt(features).alias("v"))
    return stage(rows.mapInArrow(_binned(thresholds, sparse_rows), "row long, label int, bins binary"), name)


def prepare(train: DataFrame, features: str = "features") -> Binned:
    """Rows of a training part; labels are 0, 1, ..., none of them NULL."""
    kept = stage(train.select(F.monotonically_increasing_id().alias("row"), "label", features), "forest-rows")
    n, known, most, least, whole = kept.agg(
        F.count("*"), F.count("label"), F.max("label"), F.min("label"), F.count_if(F.col("label") == F.col("label").cast("int"))
    ).first()
    if not n or known < n or whole < n or least < 0:
        raise ValueError("a forest needs rows with labels 0, 1, ...")
    thresholds, others = find_thresholds(kept, features)
    rows = to_bins(kept.withColumn("label", F.col("label").cast("int")), features, thresholds, "forest-bins", others is not None)
    return Binned(rows, thresholds, n, max(2, int(most) + 1), features, others)


@dataclass(frozen=True)
class Kept:
    """Sparse rows: row i has the values ``start[i]`` to ``start[i] + count[i]``; all others are at the places of 0."""

    start: np.ndarray
    count: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    zeros: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows, and the place in ``rows`` that each belongs to."""
        count = self.count[rows]
        owner = np.repeat(np.arange(len(rows)), count)
        return np.arange(len(owner)) + (self.start[rows] - np.cumsum(count) + count)[owner], owner

    def slices(self, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Slices of ``rows`` with about ``ENTRIES`` values each."""
        block = np.cumsum(self.count[rows]) // ENTRIES
        ends = np.append(np.flatnonzero(block[1:] != block[:-1]) + 1, len(rows)) if len(rows) else []
        return zip(np.append(0, ends[:-1]).tolist(), np.asarray(ends).tolist(), strict=True) if len(rows) else iter(())

    def at(self, rows: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """The place of one feature of each row."""
        out = self.zeros[feature]
        for begin, end in self.slices(rows):
            values, owner = self.of(rows[begin:end])
            hit = np.flatnonzero(self.feature[values] == feature[begin:end][owner])
            out[begin + owner[hit]] = self.bin[values[hit]]
        return out

    def dense(self, begin: int, end: int) -> np.ndarray:
        values, owner = self.of(np.arange(begin, end))
        out = np.tile(self.zeros, (end - begin, 1))
        out[owner, self.feature[values]] = self.bin[values]
        return out


def _kept(table: pa.Table | pa.RecordBatch, zeros: np.ndarray) -> Kept:
    column, pair = table.column("bins"), _pair(len(zeros))
    chunks = [c for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]) if len(c)]
    counts, pairs = [np.zeros(0, np.int64)], [np.zeros(0, pair)]
    for c in chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1].astype(np.int64)
        counts.append(np.diff(ends) // pair.itemsize)
        if ends[-1] > ends[0]:
            pairs.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(pair))
    count = np.concatenate(counts)
    feature, place = (np.concatenate([p[name] for p in pairs]) for name in ("feature", "bin"))
    return Kept(np.cumsum(count) - count, count, feature, place, zeros)


def _matrix(table: pa.Table | pa.RecordBatch, size: int, zeros: np.ndarray | None = None) -> np.ndarray:
    """All places of the rows; ``zeros`` are given for sparse rows."""
    if zeros is not None:
        return (rows := _kept(table, zeros)).dense(0, len(rows))
    column = table.column("bins")
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [np.concatenate([np.frombuffer(b.as_buffer(), np.uint8) for b in c]).reshape(-1, size) for c in chunks if len(c)]
    return np.concatenate(parts) if parts else np.zeros((0, size), np.uint8)


def _drawn(rows: np.ndarray, tree: int, seed: int, whole: bool) -> np.ndarray:
    """How often a tree drew each row: Poisson of mean 1 by a hash of the row's number."""
    if whole:
        return np.ones(len(rows), np.int64)
    x = rows.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return np.searchsorted(DRAWN, (x >> np.uint64(11)) / float(1 << 53), side="right")


def _subsets(rng: np.random.Generator, nodes: int, size: int, take: int) -> np.ndarray:
    """For each node ``take`` different features, all sets equally likely (Floyd)."""
    if take >= size:
        return np.tile(np.arange(size), (nodes, 1))
    out = np.empty((nodes, take), np.int64)
    for j in range(take):
        last = size - take + j
        drawn = rng.integers(0, last + 1, nodes)
        out[:, j] = np.where((out[:, :j] == drawn[:, None]).any(1), last, drawn)
    return out


def _gain(left: np.ndarray, total: np.ndarray, min_rows: int) -> np.ndarray:
    """Fall of the Gini impurity times the rows, -inf for no split; classes are the last axis."""
    right = total - left
    a, b, n = left.sum(-1), right.sum(-1), total.sum(-1)
    score = (left**2.0).sum(-1) / np.maximum(a, 1) + (right**2.0).sum(-1) / np.maximum(b, 1) - (total**2.0).sum(-1) / np.maximum(n, 1)
    return np.where((np.minimum(a, b) >= min_rows) & (score > 1e-7), score, -np.inf)


def _cells(cells: np.ndarray, bits: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The different cells, rising, and the class counts of each."""
    cells = np.sort(cells, axis=None)
    cell, label, draws = cells >> bits, (cells & ((1 << bits) - 1)) >> 4, cells & 15
    ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]), len(cell) - 1) if len(cell) else np.zeros(0, np.int64)
    sums = np.stack([np.cumsum(np.where(label == c, draws, 0))[ends] for c in range(classes)], axis=1).astype(np.int64)
    return cell[ends], np.diff(sums, axis=0, prepend=np.zeros((1, classes), np.int64))


def _kept_cells(x: Kept, key, rows, node, chosen, counts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from sparse rows; ``counts`` are the class counts of the nodes, and the rows rise by node."""
    nodes, take = chosen.shape
    classes, size = counts.shape[1], len(x.zeros)
    found = [np.zeros(0, np.int64)]
    at_once = max(1, ENTRIES // size)
    for low in range(0, nodes, at_once):
        part = chosen[low : low + at_once]
        slot = np.full((len(part), size), -1, np.int32)
        slot[np.arange(len(part))[:, None], part] = np.arange(take)
        first, last = np.searchsorted(node, [low, low + len(part)])
        own_rows, own_nodes = rows[first:last], node[first:last]
        for begin, end in x.slices(own_rows):
            values, owner = x.of(own_rows[begin:end])
            here = own_nodes[begin:end]
            place = slot.ravel()[(here[owner] - low) * size + x.feature[values]]
            hit = np.flatnonzero(place >= 0)
            own, at = owner[hit], values[hit]
            cell = (here[own] * take + place[hit]) * BINS + x.bin[at]
            found.append(cell << bits | key[own_rows[begin:end][own]])
    cell, sums = _cells(np.concatenate(found), bits, classes)
    others = np.zeros((nodes * take, classes), np.int64)
    np.add.at(others, cell // BINS, sums)
    rest = counts.repeat(take, axis=0) - others
    some = np.flatnonzero(rest.any(1))
    cell = np.concatenate([cell, some * BINS + x.zeros[chosen.ravel()[some]]])
    order = np.argsort(cell, kind="stable")
    return cell[order], np.concatenate([sums, rest[some]])[order]


def _best_splits(x, key, rows, node, chosen, counts, min_rows):
    """(gain, feature, cut, class counts of the left side) per node, from the sorted values of each node's features.

    ``key`` has class * 16 + draws of each row, ``counts`` the class counts of each node.
    """
    classes = counts.shape[1]
    bits = 4 + (classes - 1).bit_length()
    nodes, take = chosen.shape
    best, feature, cut, lefts = np.full(nodes, -np.inf), np.zeros(nodes, np.int32), np.zeros(nodes, np.uint8), np.zeros((nodes, classes), np.int64)
    sparse_rows = isinstance(x, Kept)
    if sparse_rows:
        by_node = np.argsort(node, kind="stable")
        rows, node = rows[by_node], node[by_node]
    step = max(1, 2 * ENTRIES // (nodes * classes) if sparse_rows else ENTRIES // max(1, len(rows)))
    for begin in range(0, take, step):
        part = chosen[:, begin : begin + step]
        width = part.shape[1]
        if sparse_rows:
            cell, each = _kept_cells(x, key, rows, node, part, counts, bits)
        else:
            bins = x[rows[:, None], part[node]].astype(np.int64)
            cell, each = _cells((((node[:, None] * width + np.arange(width)) * BINS + bins) << bits) | key[rows][:, None], bits, classes)
        sums = each.cumsum(0)
        run = cell // BINS  # a feature of a node; every one has rows
        last = np.append(np.flatnonzero(run[1:] != run[:-1]), len(run) - 1)
        before = np.concatenate([np.zeros((1, classes), np.int64), sums[last][:-1]])
        left, total = sums - before[run], (sums[last] - before)[run]
        gain = _gain(left, total, min_rows)
        own = run // width
        first = np.searchsorted(own, np.arange(nodes))
        most = np.maximum.reduceat(gain, first)
        hits = np.flatnonzero(gain == most[own])
        hit = hits[np.searchsorted(own[hits], np.arange(nodes))]
        better = most > best
        best[better], lefts[better], cut[better] = most[better], left[hit][better], (cell[hit] % BINS)[better]
        feature[better] = part[np.arange(nodes), run[hit] % width][better]
    return best, feature, cut, lefts


def grow_below(x, labels, draws, depth: int, min_rows: int, take: int, classes: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Features (-1: a leaf), cuts, left children (the right one is next) and class counts of a tree's nodes, level by level."""
    rows = np.flatnonzero(draws)
    node = np.zeros(len(rows), np.int64)
    key = labels * 16 + draws
    size = len(x.zeros) if isinstance(x, Kept) else x.shape[1]
    counts = np.bincount(labels, draws, classes).astype(np.int64)[None]
    levels, total = [], 0
    while True:
        n = len(counts)
        feature, cut, left = np.full(n, -1, np.int32), np.zeros(n, np.uint8), np.zeros(n, np.int32)
        levels.append((feature, cut, left, counts.astype(np.int32)))
        total += n
        can = ((counts > 0).sum(1) > 1) & (counts.sum(1) >= 2 * min_rows) & (len(levels) <= depth)
        ids = np.flatnonzero(can)
        if not len(ids):
            return [np.concatenate(c) for c in zip(*levels, strict=True)]
        kept = can[node]
        rows, node = rows[kept], (np.cumsum(can) - 1)[node[kept]]
        best, f, c, lefts = _best_splits(x, key, rows, node, _subsets(rng, len(ids), size, take), counts[ids], min_rows)
        splits = best > -np.inf
        at = ids[splits]
        feature[at], cut[at], left[at] = f[splits], c[splits], total + 2 * np.arange(len(at))
        counts = np.stack([lefts[splits], counts[at] - lefts[splits]], axis=1).reshape(-1, classes)
        kept = splits[node]
        rows, node = rows[kept], node[kept]
        bins = x.at(rows, f[node]) if isinstance(x, Kept) else x[rows, f[node]]
        node = 2 * (np.cumsum(splits) - 1)[node] + (bins > c[node])


def _walk(x: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of each row, from the nodes ``at``."""
    at = at.astype(np.int64)
    rows = np.flatnonzero(feature[at] >= 0)
    while len(rows):
        own = at[rows]
        own = left[own] + (x[rows, feature[own]] > cut[own])
        at[rows] = own
        rows = rows[feature[own] >= 0]
    return at


class Top(NamedTuple):
    """Nodes that were split by the sums of all tasks, all trees in one; the roots come first."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    counts: np.ndarray
    tree: np.ndarray
    level: np.ndarray


def grow_top(data: Binned, trees: int, depth: int, min_rows: int, take: int, seed: int, most: int) -> Top:
    """All nodes down to those of at most ``most`` rows."""
    size, classes, whole = len(data.thresholds), data.classes, trees == 1
    zeros = None if data.kept is None else _zeros(data.thresholds)
    none = np.zeros((trees, classes), np.int64)
    top = Top(np.full(trees, -1, np.int32), np.zeros(trees, np.uint8), np.zeros(trees, np.int64), none, np.arange(trees), np.zeros(trees, np.int64))
    waiting = np.arange(trees) if data.count > most else np.zeros(0, np.int64)
    rng = np.random.default_rng([seed, 1])
    while len(waiting):
        chosen = _subsets(rng, len(waiting), size, take)
        found = {}
        at_once = max(1, TOP_BYTES // (take * BINS * classes * 8))
        for begin in range(0, len(waiting), at_once):
            part, sets = waiting[begin : begin + at_once], chosen[begin : begin + at_once]
            sums = data.rows.mapInArrow(_top_sums(top, part, sets, size, classes, seed, whole, zeros), "node long, sums binary")
            tasks = max(1, min(len(part), 4 * data.rows.sparkSession.sparkContext.defaultParallelism))
            best = sums.repartition(tasks, "node").groupBy("node").applyInArrow(_top_best(take, classes, min_rows), "node long, gain double, slot int, cut int, lefts binary, totals binary")
            found |= {begin + r["node"]: (sets[r["node"]], r) for r in best.collect()}
        grown, added = top, []
        for i, node in enumerate(waiting):
            if i not in found:
                continue
            sets, r = found[i]
            totals, lefts = np.frombuffer(r["totals"], np.int64), np.frombuffer(r["lefts"], np.int64)
            grown.counts[node] = totals
            if np.isfinite(r["gain"]):
                grown.feature[node], grown.cut[node], grown.left[node] = sets[r["slot"]], r["cut"], len(grown.tree) + 2 * len(added)
                added.append((node, lefts, totals - lefts))
        n = 2 * len(added)
        parents = np.array([a[0] for a in added], np.int64).repeat(2)
        counts = np.array([c for a in added for c in a[1:]], np.int64).reshape(n, classes)
        top = Top(
            np.append(grown.feature, np.full(n, -1, np.int32)), np.append(grown.cut, np.zeros(n, np.uint8)), np.append(grown.left, np.zeros(n, np.int64)),
            np.concatenate([grown.counts, counts]), np.append(grown.tree, grown.tree[parents]), np.append(grown.level, grown.level[parents] + 1),
        )
        new = np.arange(len(grown.tree), len(top.tree))
        large = (top.counts[new].sum(1) > most) & ((top.counts[new] > 0).sum(1) > 1) & (top.level[new] < depth)
        waiting = new[large]
    return top


def _top_sums(top: Top, waiting: np.ndarray, chosen: np.ndarray, size: int, classes: int, seed: int, whole: bool, zeros: np.ndarray | None) -> Callable:
    """Class counts per bin of each waiting node's features, over the rows of a task."""
    take = chosen.shape[1]
    place = np.full(len(top.tree), -1, np.int64)
    place[waiting] = np.arange(len(waiting))
    trees = np.unique(top.tree[waiting])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(waiting), take * BINS * classes), np.int64)
        step = max(1, ENTRIES // max(size, take))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            x, y, rows = _matrix(batch, size, zeros), batch.column("label").to_numpy().astype(np.int64), batch.column("row").to_numpy()
            for tree in trees:
                draws = _drawn(rows, int(tree), seed, whole)
                at = place[_walk(x, np.full(len(x), tree), top.feature, top.cut, top.left)]
                for node in np.unique(at[(at >= 0) & (draws > 0)]):
                    own = np.flatnonzero((at == node) & (draws > 0))
                    cell = (np.arange(take) * BINS + x[own[:, None], chosen[node]]) * classes + y[own, None]
                    sums[node] += np.bincount(cell.ravel(), np.repeat(draws[own], take), sums.shape[1]).astype(np.int64)
        seen = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array([sums[i].tobytes() for i in seen], pa.binary())], names=["node", "sums"])

    return work


def _top_best(take: int, classes: int, min_rows: int) -> Callable:
    def work(table: pa.Table) -> pa.Table:
        sums = np.zeros((take, BINS, classes), np.int64)
        for b in table.column("sums").to_pylist():
            sums += np.frombuffer(b, np.int64).reshape(sums.shape)
        left = sums.cumsum(1)
        gain = _gain(left, np.broadcast_to(left[:, -1:], left.shape), min_rows)
        slot, cut = divmod(int(gain.argmax()), BINS)
        return pa.table({
            "node": table.column("node").slice(0, 1), "gain": pa.array([gain[slot, cut]], pa.float64()), "slot": pa.array([slot], pa.int32()),
            "cut": pa.array([cut], pa.int32()), "lefts": [left[slot, cut].tobytes()], "totals": [left[0, -1].tobytes()],
        })

    return work


def _dealt(top: Top, bundle_of: np.ndarray, trees: int, size: int, seed: int, whole: bool, zeros: np.ndarray | None) -> Callable:
    """Each row once for each tree that drew it and waits for it below the top."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, ENTRIES // size)
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            x, rows = _matrix(batch, size, zeros), batch.column("row").to_numpy()
            for tree in range(trees):
                to = bundle_of[_walk(x, np.full(len(x), tree), top.feature, top.cut, top.left)]
                own = np.flatnonzero((to >= 0) & (_drawn(rows, tree, seed, whole) > 0))
                part = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([pa.array(to[own]), *part.columns], names=["bundle", *part.schema.names])

    return work


def _grown(members: list[list[tuple[int, int, int]]], size: int, classes: int, depth: int, min_rows: int, take: int, seed: int, whole: bool, zeros: np.ndarray | None) -> Callable:
    """The trees, or what is below one node of a tree, that a bundle of rows is for."""

    def work(table: pa.Table) -> pa.Table:
        x = _matrix(table, size) if zeros is None else _kept(table, zeros)
        y, rows = table.column("label").to_numpy().astype(np.int64), table.column("row").to_numpy()
        order = np.argsort(rows)  # the same tree for any order of the rows
        x = x[order] if zeros is None else replace(x, start=x.start[order], count=x.count[order])
        y, rows = y[order], rows[order]
        out = []
        for tree, start, level in members[table.column("bundle")[0].as_py()]:
            rng = np.random.default_rng([seed, 2, tree, start])
            nodes = grow_below(x, y, _drawn(rows, tree, seed, whole), depth - level, min_rows, take, classes, rng)
            out.append((tree, start, len(nodes[0]), *[a.tobytes() for a in nodes]))
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
        names = ["tree", "start", "nodes", "feature", "cut", "left", "counts"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return work


def grow(data: Binned, trees: int = 100, depth: int = 16, min_rows: int = 1, seed: int = 42) -> Forest:
    """A forest with the square root of the features at each node; a single tree takes all rows and all features."""
    size, whole = len(data.thresholds), trees == 1
    take = size if whole else int(np.ceil(np.sqrt(size)))
    most = min(ROWS, data.rows_of(CELLS, KEPT))
    zeros = None if data.kept is None else _zeros(data.thresholds)
    top = grow_top(data, trees, depth, min_rows, take, seed, most)
    cores = data.rows.sparkSession.sparkContext.defaultParallelism
    if data.count <= most:
        members = [[(int(t), int(t), 0) for t in part] for part in np.array_split(np.arange(trees), min(trees, 3 * cores))]
        dealt = data.rows.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(members) - 1).cast("long"))).alias("bundle"), "row", "label", "bins")
        tasks = len(members)
    else:
        open_ = np.flatnonzero((top.feature < 0) & ((top.counts > 0).sum(1) > 1) & (top.level < depth) & (top.counts.sum(1) <= most))
        members = [[(int(top.tree[i]), int(i), int(top.level[i]))] for i in open_]
        bundle_of = np.full(len(top.tree), -1, np.int64)
        bundle_of[open_] = np.arange(len(open_))
        dealt = data.rows.mapInArrow(_dealt(top, bundle_of, trees, size, seed, whole, zeros), "bundle long, row long, label int, bins binary")
        tasks = max(1, min(len(open_), max(4 * cores, data.count * trees // data.rows_of(CELLS, KEPT))))
    grown = dealt.repartition(tasks, "bundle").groupBy("bundle").applyInArrow(
        _grown(members, size, data.classes, depth, min_rows, take, seed, whole, zeros), TREES)
    return Forest(stage(grown, "forest-trees"), top, data, trees, depth)


class Forest:
    """A fitted forest: what is below the top of its trees is a stage table."""

    def __init__(self, table: DataFrame, top: Top, data: Binned, trees: int, depth: int):
        self.table, self.top, self.trees, self.depth = table, top, trees, depth
        self.thresholds, self.classes, self.features = data.thresholds, data.classes, data.features
        self.zeros = None if data.kept is None else _zeros(data.thresholds)
        self.chunk = max(1, min(ROWS, data.rows_of(CELLS, KEPT)) // 4)  # rows that a task scores

    def _votes(self, rows: DataFrame, ends: np.ndarray) -> DataFrame:
        """(row, label, v0, v1, ...) of binned rows: class shares summed over the first trees, for each of ``ends`` and each class."""
        size, classes, top, trees = len(self.thresholds), self.classes, self.top, int(ends[-1])
        below = self.table.where(F.col("tree") < trees)
        nodes = below.agg(F.sum("nodes")).first()[0] or 0
        cores = rows.sparkSession.sparkContext.defaultParallelism
        blocks = int(min(trees, max(-(-nodes // NODES), 2 * cores)))
        chunks = max(1, -(-rows.count() // self.chunk))
        block_of = np.arange(trees) * blocks // trees
        members = [np.flatnonzero(block_of == b) for b in range(blocks)]
        width, zeros = len(ends) * classes, self.zeros
        step = max(1, 4 * ENTRIES // max(1, size))

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            parts = {}
            for r in right.to_pylist():
                parts[r["start"]] = [np.frombuffer(r[c], t) for c, t in (("feature", np.int32), ("cut", np.uint8), ("left", np.int32), ("counts", np.int32))]
            own_trees = members[left.column("_part")[0].as_py() // chunks] if len(left) else ()
            if zeros is None:
                votes = votes_of(_matrix(left, size), own_trees, parts)
            else:
                kept = _kept(left, zeros)
                each = [votes_of(kept.dense(i, min(i + step, len(kept))), own_trees, parts) for i in range(0, len(kept), step)]
                votes = np.concatenate([np.zeros((0, len(ends), classes)), *each])
            flat = votes.reshape(len(left), width)
            return pa.table([left.column("row"), left.column("label"), *[pa.array(flat[:, i]) for i in range(width)]], names=["row", "label", *[f"v{i}" for i in range(width)]])

        def votes_of(x: np.ndarray, own_trees: Sequence[int], parts: dict) -> np.ndarray:
            votes = np.zeros((len(x), len(ends), classes))
            for tree in own_trees:
                at = _walk(x, np.full(len(x), tree), top.feature, top.cut, top.left)
                own = top.counts[at].astype(float)
                for start in np.unique(at):
                    if start in parts:
                        feature, cut, child, counts = parts[start]
                        here = np.flatnonzero(at == start)
                        leaf = _walk(x[here] if len(here) < len(x) else x, np.zeros(len(here)), feature, cut, child)
                        own[here] = counts.reshape(-1, classes)[leaf]
                votes[:, np.searchsorted(ends, tree, side="right") :] += (own / np.maximum(own.sum(1, keepdims=True), 1))[:, None]
            return votes

        chunk, block = F.pmod(F.xxhash64("row"), F.lit(chunks)), F.floor(F.col("tree").cast("long") * blocks / trees)
        every = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * chunks + chunk)
        each = rows.select(F.explode(every).alias("_part"), "row", "label", "bins")
        copies = below.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(chunks - 1)), lambda c: block * chunks + c)).alias("_part_of_trees"), *below.columns)
        n = blocks * chunks
        sides = each.repartition(n, "_part").groupBy("_part").cogroup(copies.repartition(n, "_part_of_trees").groupBy("_part_of_trees"))
        found = sides.applyInArrow(work, ", ".join(["row long, label int", *[f"v{i} double" for i in range(width)]]))
        return found.groupBy("row").agg(F.first("label").alias("label"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(width)])

    def predict(self, df: DataFrame, trees: int | None = None) -> DataFrame:
        """``df`` with the prediction of the first ``trees`` trees, and the probability of class 1 as ``score``."""
        use = self.trees if trees is None else trees
        kept = stage(df.withColumn("_row", F.monotonically_increasing_id()), "forest-asked")
        asked = kept.select(F.col("_row").alias("row"), F.lit(0).alias("label"), self.features)
        votes = self._votes(to_bins(asked, self.features, self.thresholds, "forest-asked-bins", self.zeros is not None), np.array([use]))
        told = votes.select(F.col("row").alias("_row"), self._told(0).alias("prediction"), (F.col("v1") / use).alias("score"))
        return kept.drop("prediction", "score").join(told, "_row").drop("_row")

    def _told(self, place: int) -> F.Column:
        """The class with the most votes, the smallest on a tie."""
        own = F.array(*[f"v{place * self.classes + c}" for c in range(self.classes)])
        return (F.array_position(own, F.array_max(own)) - 1).cast("int")

    def accuracies(self, df: DataFrame, sizes: Sequence[int], label: str = "label") -> list[tuple[int, float]]:
        """(number of trees, accuracy) of each prefix, from one scan."""
        ends = np.array(sorted(set(sizes)))
        if not len(ends) or ends[0] < 1 or ends[-1] > self.trees:
            raise ValueError(f"a forest of {self.trees} trees has no prefix of {sizes}")
        known = F.coalesce(F.col(label).cast("int"), F.lit(-1))
        kept = stage(df.select(F.monotonically_increasing_id().alias("row"), known.alias("label"), self.features), "forest-asked")
        votes = self._votes(to_bins(kept, self.features, self.thresholds, "forest-asked-bins", self.zeros is not None), ends)
        right = votes.agg(*[F.avg((self._told(i) == F.col("label")).cast("double")) for i in range(len(ends))]).first()
        found = dict(zip(ends.tolist(), right, strict=True))
        return [(int(t), found[int(t)] or 0.0) for t in sizes]

    def _whole_trees(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        below = {}
        for r in self.table.collect():
            below[r["start"]] = [np.frombuffer(r[c], t) for c, t in (("feature", np.int32), ("cut", np.uint8), ("left", np.int32), ("counts", np.int32))]
        for tree in range(self.trees):
            own = np.flatnonzero(self.top.tree == tree)
            place = {int(i): j for j, i in enumerate(own)}
            left = np.array([place[int(c)] if f >= 0 else 0 for c, f in zip(self.top.left[own], self.top.feature[own], strict=True)], np.int64)
            nodes = [[self.top.feature[own]], [self.top.cut[own]], [left], [self.top.counts[own]]]
            at = len(own)
            for i in own:
                if int(i) in below:
                    feature, cut, child, counts = below[int(i)]
                    counts, j = counts.reshape(-1, self.classes), place[int(i)]
                    moved = child.astype(np.int64) + at - 1
                    nodes[0][0][j], nodes[1][0][j], left[j], nodes[3][0][j] = feature[0], cut[0], moved[0], counts[0]
                    for kind, more in zip(nodes, (feature[1:], cut[1:], moved[1:], counts[1:]), strict=True):
                        kind.append(more)
                    at += len(feature) - 1
            yield tree, [np.concatenate(kind) for kind in nodes]

    @cached_property
    def model(self) -> RandomForestClassificationModel:
        """The forest as a model of Spark, which the driver holds whole: for forests that fit there."""
        spark, path = self.table.sparkSession, scratch_path(self.table.sparkSession, "forest")
        rows = []
        for tree, (feature, cut, left, counts) in self._whole_trees():
            n = counts.sum(1)
            gini = 1 - ((counts / np.maximum(n, 1)[:, None]) ** 2).sum(1)
            for i in range(len(feature)):
                split = (int(feature[i]), [float(self.thresholds[feature[i], cut[i]])], -1) if feature[i] >= 0 else (-1, [], -1)
                a, b = (int(left[i]), int(left[i]) + 1) if feature[i] >= 0 else (-1, -1)
                rows.append((tree, (i, float(counts[i].argmax()), float(gini[i]), counts[i].astype(float).tolist(), int(n[i]), 0.0 if a > 0 else -1.0, a, b, split)))
        node = "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int"
        split = "featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int"
        spark.createDataFrame(rows, f"treeID int, nodeData struct<{node}, split struct<{split}>>").coalesce(1).write.parquet(f"{path}/data")

        def told(kind: str, **more) -> str:
            options = {"maxDepth": min(self.depth, 30), "featuresCol": self.features, "labelCol": "label"}
            about = {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": f"{kind}_0"}
            return json.dumps({**about, "paramMap": options, "defaultParamMap": {"impurity": "gini", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "leafCol": ""}, **more})

        about = {"numFeatures": len(self.thresholds), "numClasses": self.classes}
        each = [(t, told("DecisionTreeClassificationModel", **about), 1.0) for t in range(self.trees)]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        whole = told("RandomForestClassificationModel", **about, numTrees=self.trees)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return RandomForestClassificationModel.load(path)
