"""Principal components without a covariance matrix: a block Krylov subspace over distributed centred products.

1. A block of random columns spans the first subspace. Rayleigh-Ritz on it gives approximate components and their residuals.
2. The residuals, made orthogonal to the subspace, are the next block. One scan multiplies it: a task takes each of its rows,
   less the mean, times the block, and sends the transposed product back in chunks of dimensions, which Spark adds up.
3. A subspace of ``BLOCKS`` blocks is cut to its two best ones.

Rows stay sparse. The driver holds 2 * ``BLOCKS`` blocks of a few columns, each as long as a vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.clusters import CELLS, DIRECT, added_up

WIDTH = 8  # columns of a block, at least six more than components
BLOCKS = 6  # blocks of the widest subspace
ROUNDS = 500
CONVERGED = 1e-11  # residual of a component over the largest eigenvalue
CHUNK = 4096  # dimensions in one row of sums

Part = tuple  # ("dense", matrix) or ("sparse", bounds, index, value)


def _parts(column: pa.StructArray, size: int, width: int) -> Iterator[Part]:
    """The vectors of an unwrapped column as matrices or sparse rows, of bounded size."""
    dense = column.field("type").to_numpy(zero_copy_only=False) == 1
    values = column.filter(pa.array(dense)).field("values")
    step = max(1, CELLS // max(size, 1))
    for start in range(0, len(values), step):
        yield "dense", values.slice(start, step).flatten().to_numpy().reshape(-1, size)
    rest = column.filter(pa.array(~dense))
    if not len(rest):
        return
    index, value = (rest.field(c).flatten().to_numpy() for c in ("indices", "values"))
    bounds = np.concatenate([[0], np.cumsum(rest.field("values").value_lengths().to_numpy())])
    start, most = 0, max(1, CELLS // width)
    while start < len(rest):
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + most, side="right")) - 1)
        a, b = bounds[start], bounds[end]
        yield "sparse", bounds[start : end + 1] - a, index[a:b], value[a:b]
        start = end


def _times(part: Part, block: np.ndarray) -> np.ndarray:
    """rows @ block."""
    if part[0] == "dense":
        return part[1] @ block
    _, bounds, index, value = part
    out = np.zeros((len(bounds) - 1, block.shape[1]))
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(value[:, None] * block[index], bounds[full])
    return out


def _add_back(part: Part, y: np.ndarray, total: np.ndarray) -> None:
    """total += rows.T @ y."""
    if part[0] == "dense":
        total += part[1].T @ y
        return
    _, bounds, index, value = part
    if not len(index):
        return
    order = np.argsort(index, kind="stable")
    first = np.flatnonzero(np.diff(index[order], prepend=-1))
    row = np.repeat(np.arange(len(y)), np.diff(bounds))
    total[index[order][first]] += np.add.reduceat(value[order, None] * y[row[order]], first)


class _Rows:
    """Cached vectors, and products with them."""

    def __init__(self, rows: DataFrame, size: int, count: int):
        self.rows, self.size, self.count = rows, size, count
        self.tasks = rows.rdd.getNumPartitions()
        self.mean = np.zeros(size)

    def _sums(self, work: Callable, width: int) -> np.ndarray:
        """Sum over all tasks of what ``work`` adds to a matrix (size x width) for each part of their rows."""
        size = self.size

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, width))
            for batch in batches:
                for part in _parts(batch.column(0), size, width):
                    work(part, total)
            for i in range(0, size, CHUNK):
                chunk = total[i : i + CHUNK]
                if chunk.any():
                    values = pa.array([chunk.ravel()], pa.list_(pa.float64()))
                    task = pa.array([TaskContext.get().partitionId()])
                    yield pa.RecordBatch.from_arrays([pa.array([i]), task, values], names=["i", "task", "y"])

        kind = "i long, task long, y array<double>"
        parts = self.rows.mapInArrow(of_task, kind)
        if self.tasks * size * width * 8 > DIRECT:
            parts = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(added_up, kind)
        out = np.zeros((size, width))
        # At most one row per task and chunk within DIRECT bytes, else one row per chunk; the same order whichever task ends first.
        found = parts.toArrow()
        keys = zip(found.column("i").to_pylist(), found.column("task").to_pylist(), strict=True)
        for (i, _), y in sorted(zip(keys, found.column("y"), strict=True), key=lambda row: row[0]):
            out[i : i + CHUNK] += y.values.to_numpy().reshape(-1, width)
        return out

    def center(self) -> None:
        def work(part: Part, total: np.ndarray) -> None:
            _add_back(part, np.ones((len(part[1]) - (part[0] == "sparse"), 1)), total)

        self.mean = self._sums(work, 1)[:, 0] / max(self.count, 1)

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance (divisor: the number of rows) times ``block``."""
        mean = self.mean
        shift, width = mean @ block, block.shape[1]
        sent = self.rows.sparkSession.sparkContext.broadcast((block, mean, shift))

        def work(part: Part, total: np.ndarray) -> None:
            block, mean, shift = sent.value
            if part[0] == "dense":
                centred = part[1] - mean
                total += centred.T @ (centred @ block)
                return
            y = _times(part, block) - shift
            _add_back(part, y, total)
            total -= np.outer(mean, y.sum(0))

        try:
            return self._sums(work, width) / max(self.count, 1)
        finally:
            sent.unpersist()


@contextmanager
def _rows_of(df: DataFrame, features: str):
    rows = df.select(F.unwrap_udt(features).alias("v")).where("v is not null").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = F.coalesce("v.size", F.size("v.values"))
        low, high, count = rows.agg(F.min(size), F.max(size), F.count(F.lit(1))).first()
        if low != high:
            raise ValueError(f"vectors of {low} and of {high} entries")
        yield _Rows(rows, low or 0, count)
    finally:
        rows.unpersist()


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that add to ``basis`` what ``block`` has beyond it; dependent ones are left out."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        left, found, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, found > 1e-10]
    return block


@dataclass(frozen=True)
class Components:
    """``loadings`` (dimensions x components, unit columns), the ``mean`` of the rows, and ``variances`` (divisor: rows)."""

    loadings: np.ndarray
    mean: np.ndarray
    variances: np.ndarray
    products: int  # scans of the rows that the fit took

    def transform(self, df: DataFrame, features: str = "features", out: str = "components") -> DataFrame:
        """``df`` with ``out`` ARRAY<DOUBLE>: the centred row on each component; null for a null vector."""
        size, width = self.loadings.shape
        sent = df.sparkSession.sparkContext.broadcast((self.loadings, self.mean @ self.loadings))

        @F.arrow_udf("array<double>")
        def projected(vectors: pa.Array) -> pa.Array:
            loadings, shift = sent.value
            known = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            column = vectors.take(pa.array(known))
            # Dense rows come first out of the parts.
            kinds = column.field("type").to_numpy(zero_copy_only=False)
            order = np.concatenate([np.flatnonzero(kinds == 1), np.flatnonzero(kinds != 1)])
            scores = np.zeros((len(known), width))
            found = [_times(p, loadings) for p in _parts(column, size, width)]
            if found:
                scores[order] = np.concatenate(found) - shift
            lists = pa.FixedSizeListArray.from_arrays(pa.array(scores.ravel()), width).cast(pa.list_(pa.float64()))
            place = np.full(len(vectors), -1)
            place[known] = np.arange(len(known))
            return lists.take(pa.array(place, mask=place < 0))

        return df.withColumn(out, projected(F.unwrap_udt(features)))


def fit_components(df: DataFrame, k: int, features: str = "features", seed: int = 42) -> Components:
    """The ``k`` components of largest variance of a vector column, dense or sparse.

    Each is a unit vector whose largest loading (the first of equal ones) is positive. Null vectors do not count. Directions
    without variance are as good as any other, and are zero where the vectors have fewer than ``k`` entries. An empty table
    gives components of no dimension. Vectors of different lengths are an error.
    """
    with _rows_of(df, features) as rows:
        if not rows.size:
            return Components(np.zeros((0, k)), np.zeros(0), np.zeros(k), 0)
        rows.center()
        width = min(max(WIDTH, k + 6), rows.size)
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((rows.size, width)))[0]
        image, products = rows.times(basis), 1
        while True:
            small = basis.T @ image
            values, vectors = np.linalg.eigh((small + small.T) / 2)
            values, vectors = values[::-1], vectors[:, ::-1]
            top = vectors[:, :width]
            open_part = image @ top - (basis @ top) * values[:width]
            residuals = np.linalg.norm(open_part, axis=0)
            least = CONVERGED * max(values[0], 0.0)
            if (residuals[:k] <= least).all():
                break
            if products == ROUNDS:
                raise RuntimeError(f"components not found in {ROUNDS} scans; residuals {residuals[:k] / values[0]}")
            if basis.shape[1] + width > BLOCKS * width:
                best = vectors[:, : 2 * width]
                basis, image = basis @ best, image @ best
            added = _new_directions(open_part[:, residuals > least / 10], basis)
            if not added.shape[1]:
                break
            basis, image, products = np.hstack([basis, added]), np.hstack([image, rows.times(added)]), products + 1
        loadings, variances = np.zeros((rows.size, k)), np.zeros(k)
        found = min(k, width)
        # A basis cut several times has lost some digits of its length.
        loadings[:, :found] = np.linalg.qr((basis @ vectors)[:, :found])[0] if found else 0
        variances[:found] = np.maximum(values[:found], 0)
        peaks = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
        return Components(loadings * np.where(peaks < 0, -1.0, 1.0), rows.mean, variances, products)
