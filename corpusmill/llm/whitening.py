"""Embedding whitening by block Jacobi-Davidson over distributed centred products.

Entries become whole numbers, so that sums, means and squared deviations are exact. The covariance is never made: a product
with a block of vectors is one pass in which each task multiplies its own centred rows, and Spark sums the parts by dimension.

1. A block of start vectors spans the first subspace. Rayleigh-Ritz on it gives approximate eigenpairs and their residuals.
2. Pairs whose residual is down to double precision are locked.
3. For the pairs still open, the correction equations, projected against the locked vectors and the open ones, are solved
   roughly by MINRES. The columns go in lockstep, so that one distributed product serves all of them.
4. The corrections widen the subspace; beyond ``SUBSPACE`` blocks it restarts from its best vectors.

The driver holds only columns as long as a vector: at most ``SUBSPACE`` + 1 blocks of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.names import unused
from corpusmill.sources.staging import stage

SCALE, OFFSET = 64, 1_000_000
LIMIT = float(1 << 40)  # larger scaled entries are no embedding: such a vector is left out, as one that is not finite
SUBSPACE = 4  # blocks of the largest subspace
INNER = 8  # MINRES steps of one correction
INNER_DROP = 0.05  # or until the correction's residual is down to this share
OUTER = 200
ROUNDING = 2 * np.finfo(float).eps  # residual over the largest eigenvalue that counts as double precision
STALLED = 16  # times that, if a round no longer halves it: what is left is the rounding of the products
LEAST = 1e-12  # an eigenvalue under this share of the largest is rounding, not a direction
ROWS = 4096  # rows that a task multiplies at once


def whole_vectors(df: DataFrame, vector: str) -> tuple[DataFrame, str, str]:
    """Rows with a usable vector, its entries x = floor(64 * c) + 1000000 as an array, and that array's length.

    Left out are vectors that are null or empty or hold a null or non-finite entry, or one beyond 2**40 after scaling.
    """
    x, size = unused(df.columns, "x", "size")
    given = F.col(f"`{vector}`")
    scaled = F.transform(given, lambda c: c.cast("double") * SCALE)
    sound = (F.size(given) > 0) & F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    rows = df.where(F.coalesce(sound, F.lit(False)))
    whole = F.transform(scaled, lambda c: F.floor(c).cast("long") + OFFSET)
    return rows.withColumns({x: whole, size: F.size(given)}), x, size


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(size: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            low += (x & 0xFFFFF).sum(0)
            high += (x >> 20).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(low), pa.array(high)], names=["i", "low", "high"])

    return work


def exact_sums(vectors: DataFrame, size: int) -> list[int]:
    """Sum of each dimension, as exact whole numbers; ``vectors`` has the array as its only column."""
    parts = vectors.mapInArrow(_sums(size), "i int, low long, high long")
    rows = parts.groupBy("i").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()  # one row per dimension
    out = [0] * size
    for r in rows:
        out[r["i"]] = r["low"] + (r["high"] << 20)
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n in double, rounded once: whole part and remainder of the means are taken off apart.

    ``sums`` has the whole part and the remainder of each S/n, so that nothing overflows however many rows there are.
    """
    return (x - sums[0]).astype(np.float64) - sums[1] / n


def _products(n: int, means: np.ndarray, block: np.ndarray) -> Callable:
    size, width = block.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                c = centred(_matrix(batch.column(0).slice(start, ROWS), size), n, means)
                total += c.T @ (c @ block)
        values = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * width, pa.int32()), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), values], names=["i", "y"])

    return work


class Covariance:
    """The covariance of staged vectors as an operator: one distributed pass for each product with a block."""

    def __init__(self, vectors: DataFrame, n: int, sums: list[int]):
        self.vectors, self.n, self.size, self.passes = vectors, n, len(sums), 0
        self.means = np.array([[s // n for s in sums], [s % n for s in sums]], dtype=np.int64)

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        width = block.shape[1]
        parts = self.vectors.mapInArrow(_products(self.n, self.means, block), "i int, y array<double>")
        sums = F.array(*[F.sum(F.get("y", F.lit(j))) for j in range(width)]).alias("y")
        rows = parts.groupBy("i").agg(sums).collect()  # one row per dimension
        out = np.zeros((self.size, width))
        for r in rows:
            out[r["i"]] = r["y"]
        self.passes += 1
        return out / self.n


def _off(basis: np.ndarray, t: np.ndarray) -> np.ndarray:
    """``t`` without its part along ``basis``; twice, as once leaves rounding behind."""
    for _ in range(2):
        t = t - basis @ (basis.T @ t)
    return t


def minres(product: Callable, right: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Rough solutions of symmetric systems, one per column, in lockstep; ``product`` takes all columns at once.

    Paige and Saunders' recurrences: a Lanczos step, a Givens rotation and a short update for every column. A column whose
    Lanczos process has ended stays as it is.
    """
    size, width = right.shape
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = np.maximum(beta, 1e-300)
    old, v = np.zeros_like(right), right / start
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    phi = beta.copy()
    cos_old, sin_old, cos, sin = np.ones(width), np.zeros(width), np.ones(width), np.zeros(width)
    beta_here = np.zeros(width)
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        y = product(v)
        alpha = (v * y).sum(0)
        y = y - alpha * v - beta_here * old
        beta_next = np.linalg.norm(y, axis=0)
        epsilon, delta_here = sin_old * beta_here, cos_old * beta_here
        delta, gamma_bar = cos * delta_here + sin * alpha, -sin * delta_here + cos * alpha
        gamma = np.maximum(np.hypot(gamma_bar, beta_next), 1e-300)
        cos_old, sin_old = cos, sin
        cos, sin = gamma_bar / gamma, beta_next / gamma
        w_new = (v - epsilon * w_old - delta * w) / gamma
        x = np.where(live, x + cos * phi * w_new, x)
        phi = np.where(live, -sin * phi, phi)
        w_old, w = w, w_new
        live &= (beta_next > 1e-13 * start) & (np.abs(phi) > drop * start)
        old, v, beta_here = v, y / np.maximum(beta_next, 1e-300), beta_next
    return x


def jacobi_davidson(matrix, size: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a positive semidefinite ``matrix`` that has only ``@``.

    Every residual ends under ``ROUNDING`` times the largest eigenvalue (times the root of the size, the rounding of a
    product), or under ``STALLED`` times that where it no longer halves in a round; otherwise the job fails.
    """
    wanted = min(wanted, size)
    block = min(size, wanted + 2)  # two more than wanted, as the last pairs converge slowest
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
    image = matrix @ basis
    before = np.inf
    for _ in range(OUTER):
        inner = basis.T @ image
        values, small = np.linalg.eigh((inner + inner.T) / 2)
        small = small[:, ::-1]
        values, ritz, ritz_image = values[::-1][:block], basis @ small[:, :block], image @ small[:, :block]
        residual = ritz_image - ritz * values
        norms = np.linalg.norm(residual, axis=0)
        small_enough = ROUNDING * np.sqrt(size) * max(values[0], 1e-300)
        done, worst = norms <= small_enough, norms[:wanted].max()
        if worst <= small_enough or before / 2 < worst <= STALLED * small_enough:
            return values[:wanted], ritz[:, :wanted]
        before = worst
        if basis.shape[1] + (~done).sum() > min(size, SUBSPACE * block) and basis.shape[1] > block:
            keep = small[:, : min(2 * block, basis.shape[1])]
            basis, image = basis @ keep, image @ keep
        open_ones = np.flatnonzero(~done)
        # Locked and open vectors together are the space that a correction may not lie in.
        theta, right = values[open_ones], -_off(ritz, residual[:, open_ones])

        def product(t: np.ndarray) -> np.ndarray:
            return _off(ritz, matrix @ t - t * theta)

        t = minres(product, right, INNER, INNER_DROP)
        t = t / np.maximum(np.linalg.norm(t, axis=0), 1e-300)
        new = _orthonormal(_off(basis, t), basis)
        if not new.shape[1]:  # the corrections brought nothing new: go on from vectors not seen yet
            if basis.shape[1] >= size:
                image = matrix @ basis  # the whole space, with fresh products
                continue
            new = _orthonormal(_off(basis, np.random.default_rng(seed + 1).standard_normal((size, min(block, size - basis.shape[1])))), basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, matrix @ new])
    raise ArithmeticError(f"residuals did not come down to double precision in {OUTER} rounds")


def _orthonormal(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit columns that span ``t`` and stand upright on ``basis``; columns that add nothing are left out."""
    room = basis.shape[0] - basis.shape[1]
    if room <= 0 or not t.shape[1]:
        return t[:, :0]
    left, weight, _ = np.linalg.svd(t, full_matrices=False)
    left = left[:, : min(room, int((weight > 1e-8 * max(weight[0], 1e-300)).sum()))]
    return np.linalg.qr(_off(basis, left))[0]


@dataclass
class Whitening:
    """Exact sums, and the leading components with their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray  # one column per component
    trace: float


def fit(vectors: DataFrame, wanted: int = 32) -> Whitening:
    """Fit over staged ``vectors`` whose only column is an array of whole numbers, all of one length.

    No rows, or no two different ones, give no component; neither do directions of no variance.
    """
    first = vectors.first()
    if first is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    size, n = len(first[0]), vectors.count()
    sums = exact_sums(vectors, size)
    covariance = Covariance(vectors, n, sums)
    # One product with the unit vectors of each block of dimensions would be the covariance; the trace needs squares alone.
    squares = vectors.mapInArrow(_squares(n, covariance.means, size), "v double").agg(F.sum("v")).first()[0]
    trace = squares / n
    if not trace > 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    values, found = jacobi_davidson(covariance, size, wanted)
    real = values > LEAST * values[0]
    return Whitening(n, sums, values[real], found[:, real], trace)


def _squares(n: int, means: np.ndarray, size: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            c = centred(_matrix(batch.column(0), size), n, means)
            total += float((c * c).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["v"])

    return work


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (n*x - S)**2, exact; None beyond 64 bits."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    apart = x - whole
    largest = float(np.abs(apart).max(initial=0)) * n + n
    if largest * largest * len(sums) < 2.0**62:
        d = apart * n - rest
        return (d * d).sum(1).tolist()
    d = apart.astype(object) * n - rest.astype(object)
    return [v if v < 1 << 63 else None for v in ((d * d).sum(1)).tolist()]


def _whiten(model: Whitening, at: int) -> Callable:
    means = np.array([[s // model.n for s in model.sums], [s % model.n for s in model.sums]], dtype=np.int64)
    scaled = model.vectors / np.sqrt(model.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, width = scaled.shape
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _matrix(batch.column(at), size)
                w = centred(x, model.n, means) @ scaled
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(w.ravel()))
                keep = [i for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in keep], pa.array(exact_deviations(x, model.n, model.sums), pa.int64()), listed],
                    names=[*[batch.schema.names[i] for i in keep], "deviation", "whitened"],
                )

    return work


def _moments(width: int) -> Callable:
    """Sums of the whitened rows and of their products, one row per component."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            w = _matrix(batch.column(0), width)
            total[:, 0] += w.sum(0)
            total[:, 1:] += w.T @ w
        values = pa.ListArray.from_arrays(pa.array(np.arange(width + 1) * (width + 1), pa.int32()), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), values], names=["i", "y"])

    return work


def identity_error(whitened: DataFrame, n: int, width: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity.

    Their mean is zero up to rounding, so taking its square off the mean product loses nothing.
    """
    parts = whitened.mapInArrow(_moments(width), "i int, y array<double>")
    sums = F.array(*[F.sum(F.get("y", F.lit(j))) for j in range(width + 1)]).alias("y")
    total = np.zeros((width, width + 1))
    for r in parts.groupBy("i").agg(sums).collect():  # one row per component
        total[r["i"]] = r["y"]
    mean = total[:, 0] / n
    return float(np.abs(total[:, 1:] / n - np.outer(mean, mean) - np.eye(width)).max())


def whiten(df: DataFrame, vector: str, wanted: int = 32) -> tuple[DataFrame, Whitening, float]:
    """Usable rows with deviation and whitened (an array, one entry per component), the model, and its identity error.

    Rows with a vector that is null, empty, or holds a null or non-finite entry (or one beyond 2**40 after scaling) go. If
    lengths differ, those of the most frequent length stay, the longer one on a tie. Repeated rows and null keys count as rows.
    An empty table, or one whose vectors are all equal, gives no components, so empty arrays. deviation is null beyond 64 bits.
    Columns of ``df`` named deviation or whitened are replaced, and the vector column is left out.
    """
    taken = {"deviation", "whitened", vector.lower()}
    rows, x, size = whole_vectors(df, vector)
    kept = [c for c in df.columns if c.lower() not in taken]
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(x), F.col(size))
    common = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc(size)).first()
    rows = stage(rows.where(F.col(size) == (common[size] if common else 0)).drop(size), "whole-vectors")
    model = fit(rows.select(x), wanted)
    if not len(model.values):
        none = F.array().cast("array<double>")
        zero = F.lit(0 if model.n else None).cast("long")
        return rows.drop(x).withColumns({"deviation": zero, "whitened": none}), model, 0.0
    kinds = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != x], "deviation long", "whitened array<double>"])
    out = rows.mapInArrow(_whiten(model, len(kept)), kinds)
    return out, model, identity_error(out.select("whitened"), model.n, len(model.values))


def explained(model: Whitening) -> Column:
    """Each component's share of the whole variance, as an array."""
    return F.array(*[F.lit(float(v / model.trace)) for v in model.values])
