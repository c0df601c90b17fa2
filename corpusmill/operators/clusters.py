"""k-means for a whole grid at once: every k and every start shares each scan of the rows.

1. One scan gives the mean, which is taken off all rows for the sake of precision.
2. A few scans draw candidates, each row with a chance in proportion to its squared distance from those drawn before, and one
   more counts the rows next to each candidate. All starts choose their first centers from these weighted candidates.
3. In each iteration a task assigns its rows to the centers of all runs by one matrix product, and sends sums per center.
   Runs whose centers no longer move drop out.

Sparse vectors stay sparse until a task takes a few of them at a time; sums per center are taken over their entries. The driver holds the centers only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 3  # scans that draw candidates
DRAWN = 8  # candidates of each scan, per cluster of the largest k
MOVED = 1e-4  # a run has converged when no center moves further
CELLS = 1 << 22  # distances that a task works out at once
DIRECT = 1 << 20  # bytes of the tasks' sums of a scan that the driver adds up itself; more are added up by Spark first
WIDTH = 1 << 22  # coordinates of the centers that one scan takes; a wider grid takes several scans

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # row, place and value of each entry of sparse vectors


class Clusters(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted centers; adds the number of the nearest one as the column ``cluster``."""

    centers = Param(Params._dummy(), "centers", "coordinates of each center", TypeConverters.identity)
    features = Param(Params._dummy(), "features", "vector column", TypeConverters.toString)
    cost = Param(Params._dummy(), "cost", "sum of squared distances of the fitted rows", TypeConverters.toFloat)

    def __init__(self, centers: np.ndarray | None = None, features: str = "features", cost: float = 0.0):
        super().__init__()
        self._set(centers=[] if centers is None else np.asarray(centers, float).tolist(), features=features, cost=float(cost))

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.getOrDefault(self.centers)]

    @property
    def trainingCost(self) -> float:
        return self.getOrDefault(self.cost)

    def _transform(self, df: DataFrame) -> DataFrame:
        centers = np.array(self.clusterCenters())
        shift = centers.mean(0)

        @F.arrow_udf("int")
        def nearest(vectors: pa.Array) -> pa.Array:
            out = np.zeros(len(vectors), np.int32)
            rows = max(1, CELLS // max(centers.size, 1))
            for start in range(0, len(vectors), rows):
                x, _ = _dense(vectors.slice(start, rows), centers.shape[1])
                out[start : start + rows] = _distances(x - shift, centers - shift).argmin(1)
            return pa.array(out)

        return df.withColumn("cluster", nearest(self.getOrDefault(self.features)))


def _dense(vectors: pa.StructArray, size: int) -> tuple[np.ndarray, Entries | None]:
    """The vectors as a matrix; if none is a dense one, also the row, place and value of each entry."""
    indices, values = (vectors.field(name) for name in ("indices", "values"))
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    lengths = values.value_lengths().fill_null(0).to_numpy()
    sizes = np.where(sparse, vectors.field("size").fill_null(-1).to_numpy(zero_copy_only=False), lengths)
    if vectors.null_count or (sizes != size).any():
        raise ValueError(f"a vector is null or not of size {size}")
    value = values.flatten().to_numpy(zero_copy_only=False)
    if not sparse.any():
        return value.reshape(-1, size), None
    row, of_sparse = np.repeat(np.arange(len(vectors)), lengths), np.repeat(sparse, lengths)
    x = np.zeros((len(vectors), size))
    place = indices.flatten().to_numpy(zero_copy_only=False)
    x[row[of_sparse], place] = value[of_sparse]
    if sparse.all():
        return x, (row, place, value)
    x[~sparse] = value[~of_sparse].reshape(-1, size)
    return x, None


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances less the squared length of each row, which no comparison of centers needs."""
    return (centers * centers).sum(1) - 2 * (x @ centers.T)


def _matrix(batch: pa.RecordBatch, size: int, shift: np.ndarray) -> Iterator[tuple[np.ndarray, Entries | None]]:
    """The vectors less ``shift``, some at a time, and the entries of sparse ones."""
    column = batch.column(0).drop_null()
    rows = max(1, CELLS // max(size, len(shift), 1))
    for start in range(0, len(column), rows):
        x, entries = _dense(column.slice(start, rows), len(shift))
        yield x - shift, entries


class _Points:
    """Cached rows of one vector column, and sums over them."""

    def __init__(self, rows: DataFrame, size: int, tasks: int):
        self.rows, self.size, self.tasks = rows, size, tasks
        self.shift = np.zeros(size)

    def sums(self, work: Callable, count: int, width: int) -> np.ndarray:
        """Sum over all tasks of the matrix (count x width) that ``work`` makes of its matrices of rows."""

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((count, width))
            for batch in batches:
                for x, entries in _matrix(batch, count, shift):
                    total += work(x, entries)
            values = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * width, pa.int32()), pa.array(total.ravel()))
            task = np.full(count, TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(task), values], names=["i", "task", "y"])

        shift = self.shift
        parts = self.rows.mapInArrow(of_task, "i long, task long, y array<double>")
        if self.tasks * count * width * 8 > DIRECT:
            parts = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(added_up, "i long, task long, y array<double>")
        found = parts.toArrow().combine_chunks()
        out = np.zeros((count, width))
        if found.num_rows:
            order = np.lexsort((found.column(1).to_numpy(), found.column(0).to_numpy()))  # the same order whichever task ends first
            values = found.column(2).combine_chunks().flatten().to_numpy().reshape(-1, width)
            np.add.at(out, found.column(0).to_numpy()[order], values[order])
        return out

    def draw(self, candidates: np.ndarray, count: int, seed: int) -> np.ndarray:
        """``count`` rows, drawn without return with weights of their squared distance from the candidates."""
        shift = self.shift

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
            keys, kept = np.zeros(0), np.zeros((0, len(shift)))
            for batch in batches:
                for x, _ in _matrix(batch, max(len(candidates), 1), shift):
                    weight = np.maximum(_distances(x, candidates).min(1) + (x * x).sum(1), 0) if len(candidates) else np.ones(len(x))
                    key = np.log(1 - rng.random(len(x))) / np.where(weight > 0, weight, 1)
                    key[weight <= 0] = -np.inf
                    keys, kept = np.concatenate([keys, key]), np.concatenate([kept, x])
                    best = np.argsort(-keys, kind="stable")[:count]
                    best = best[np.isfinite(keys[best])]
                    keys, kept = keys[best], kept[best]
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * len(shift), pa.int32()), pa.array(kept.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(keys), values], names=["key", "x"])

        drawn = self.rows.mapInArrow(of_task, "key double, x array<double>").orderBy(F.desc("key"), "x").limit(count).collect()
        return np.array([r["x"] for r in drawn], float).reshape(-1, len(shift))


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of rows with the same number, their arrays summed in the order of the rows."""
    last, total = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([0]), pa.array([total], pa.list_(pa.float64()))], names=["i", "task", "y"])

    for batch in batches:
        for i, y in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            values = y.values.to_numpy(zero_copy_only=False)
            if i == last:
                total = total + values
                continue
            if last is not None:
                yield out()
            last, total = i, values
    if last is not None:
        yield out()


@contextmanager
def _points(df: DataFrame, features: str):
    rows = df.select(F.col(features).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.first()
        yield _Points(rows, first[0].size if first else 0, rows.rdd.getNumPartitions())
    finally:
        rows.unpersist()


def _first_centers(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ over weighted candidates. With fewer than k different ones, some are taken twice."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    far = ((candidates - candidates[chosen[0]]) ** 2).sum(1)
    for _ in range(k - 1):
        share = far * weights
        chosen.append(int(rng.choice(len(candidates), p=share / share.sum() if share.sum() > 0 else weights / weights.sum())))
        far = np.minimum(far, ((candidates - candidates[chosen[-1]]) ** 2).sum(1))
    return candidates[chosen]


def _assign(centers: np.ndarray, bounds: list[int], shift: np.ndarray) -> Callable:
    """Per center: the sum of its rows less ``shift``, their number and their squared distances from it."""

    def work(x: np.ndarray, entries: Entries | None) -> np.ndarray:
        apart, at = _distances(x, centers), np.arange(len(x))
        own, size = (x * x).sum(1), x.shape[1]
        sums, count, cost = np.zeros((len(centers), size)), np.zeros(len(centers)), np.zeros(len(centers))
        hot = np.zeros((len(x), len(centers))) if entries is None else None
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            best = apart[:, a:b].argmin(1)
            count[a:b] = np.bincount(best, minlength=b - a)
            cost[a:b] = np.bincount(best, weights=apart[at, a + best] + own, minlength=b - a)
            if entries is None:
                hot[at, a + best] = 1
            else:
                row, place, value = entries
                found = np.bincount(best[row] * size + place, weights=value, minlength=(b - a) * size)
                sums[a:b] = found.reshape(-1, size) - count[a:b, None] * shift
        return np.column_stack([sums if hot is None else hot.T @ x, count, cost])

    return work


def lloyd(points: _Points, starts: list[np.ndarray], max_iter: int) -> list[tuple[np.ndarray, float]]:
    """Centers and cost of each run, from its first centers (as rows less ``points.shift``)."""
    runs = [(c.copy(), np.inf) for c in starts]
    live = list(range(len(runs)))
    for turn in range(max_iter + 1):
        if not live:
            break
        still = []
        group, groups, width = [], [], 0
        for r in live:
            group, width = [*group, r], width + runs[r][0].size
            if width >= WIDTH:
                groups, group, width = [*groups, group], [], 0
        for group in [*groups, group] if group else groups:
            bounds = np.cumsum([0, *[len(runs[r][0]) for r in group]]).tolist()
            found = points.sums(_assign(np.concatenate([runs[r][0] for r in group]), bounds, points.shift), bounds[-1], points.size + 2)
            for r, a, b in zip(group, bounds[:-1], bounds[1:], strict=True):
                before, part = runs[r][0], found[a:b]
                runs[r] = (before, float(part[:, -1].sum()))  # the cost of these centers
                rows = part[:, -2:-1]
                after = np.where(rows > 0, part[:, :-2] / np.maximum(rows, 1), before)
                if turn < max_iter and np.sqrt(((after - before) ** 2).sum(1)).max() > MOVED:
                    runs[r] = (after, np.inf)
                    still.append(r)
        live = still
    return runs


def fit_grid(
    df: DataFrame, ks: Iterable[int], n_init: int = 1, features: str = "features", seed: int = 42, max_iter: int = 300
) -> dict[int, Clusters]:
    """For each k the run of lowest cost among ``n_init`` starts. An empty table gives no center."""
    ks = sorted(set(ks))
    with _points(df, features) as points:
        if not points.size:
            return {k: Clusters(np.zeros((0, 0)), features) for k in ks}
        total = points.sums(lambda x, _: np.append(x.sum(0), len(x))[None], 1, points.size + 1)[0]
        points.shift = total[:-1] / total[-1]
        candidates = points.draw(np.zeros((0, points.size)), 1, seed)
        for turn in range(ROUNDS):
            candidates = np.concatenate([candidates, points.draw(candidates, DRAWN * max(ks), seed + turn + 1)])
        weights = points.sums(_assign(candidates, [0, len(candidates)], points.shift), len(candidates), points.size + 2)[:, -2]
        runs = [(k, start) for k in ks for start in range(n_init)]
        firsts = [_first_centers(candidates, weights, k, np.random.default_rng([seed, start, k])) for k, start in runs]
        best: dict[int, Clusters] = {}
        for (k, _), (centers, cost) in zip(runs, lloyd(points, firsts, max_iter), strict=True):
            if k not in best or cost < best[k].trainingCost:
                best[k] = Clusters(centers + points.shift, features, cost)
        return best
