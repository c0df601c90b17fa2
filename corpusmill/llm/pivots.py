"""Exact inner-product search by pivot-table elimination.

The distances of every vector to the pivots are computed once. For a query the largest difference of the two distances
to a pivot is a lower bound of the distance, and (|q|^2 + |x|^2 - bound^2) / 2 an upper bound of the inner product. Candidates are
evaluated in the order of that bound, until the next bound is below the k-th best score. Queries and candidates meet in blocks of
bounded size; a block starts with the k-th best score that the query has among the pivots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm.words import groups_of
from corpusmill.sources.staging import stage

EXACT = 1 << 52  # sums up to here are exact in double precision
STEP = 64  # candidates evaluated between two looks at the bound


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """(vec_id, v): components as floor(scale * x). Rows with a null key, a null vector, or a null or non-finite component
    are left out."""
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), x.alias("x")).where(finite & F.col("vec_id").isNotNull())
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(len(flat), len(values) // max(len(flat), 1))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every sum fits, else in 64-bit integers."""
    size = max(float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1), 1.0)
    if size < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = a.astype(np.float64), b.astype(np.float64)
    return np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))


def _with_table(pivots: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> Callable:
    """Adds the distances to the pivots of the same length, and the k-th best score among them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                ids, vectors = batch.column(0).to_pylist(), batch.column(1)
                table, floor = [], []
                for vec_id, v in zip(ids, vectors, strict=True):
                    v = v.values.to_numpy(zero_copy_only=False).astype(np.int64)[None, :]
                    names, points = pivots.get(v.shape[1], (np.zeros(0, np.int64), np.zeros((0, v.shape[1]), np.int64)))
                    table.append(_distances(v, points)[0])
                    scores = np.sort(_dot(v, points)[0][names != vec_id])
                    floor.append(int(scores[-k]) if len(scores) >= k else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), vectors, pa.array(table, pa.list_(pa.float64())), pa.array(floor, pa.int64())],
                    names=["vec_id", "v", "table", "floor"],
                )

    return work


def upper_bounds(q: np.ndarray, q_table: np.ndarray, x: np.ndarray, x_table: np.ndarray) -> np.ndarray:
    """No inner product of a row of ``q`` and a row of ``x`` is larger."""
    apart = np.zeros((len(q), len(x)))
    for p in range(q_table.shape[1]):
        np.maximum(apart, np.abs(q_table[:, p, None] - x_table[None, :, p]), out=apart)
    norms = (q.astype(np.float64) ** 2).sum(1)[:, None] + (x.astype(np.float64) ** 2).sum(1)[None, :]
    return (norms - apart**2) / 2 + 1 + 1e-9 * norms  # room for rounding


def _search(k: int) -> Callable:
    """The k best candidates of each query of a block: rows (q_block, c_block, dim, row, vec_id, v, table, floor, asks)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups_of(batches, 3):
            asks = block.column("asks").to_numpy()
            ids, places = block.column("vec_id").to_numpy(), block.column("row").to_numpy()
            x, table = _matrix(block.column("v"), np.int64), _matrix(block.column("table"), np.float64)
            floors = block.column("floor").to_pylist()
            rest = np.flatnonzero(~asks)
            if not asks.any() or not len(rest):
                continue
            named, points = ids[rest], x[rest]
            out_row, out_query, out_id, out_score = [], [], [], []
            for i in np.flatnonzero(asks):
                bound = upper_bounds(x[i : i + 1], table[i : i + 1], points, table[rest])[0]
                bound[named == ids[i]] = -np.inf
                order = np.argsort(-bound, kind="stable")
                order = order[: np.count_nonzero(bound > -np.inf)]
                floor = -np.inf if floors[i] is None else floors[i]
                best_id, best_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for start in range(0, len(order), STEP):
                    part = order[start : start + STEP]
                    least = max(floor, best_score[-1]) if len(best_score) == k else floor
                    if bound[part[0]] < least:
                        break
                    best_id = np.concatenate([best_id, named[part]])
                    best_score = np.concatenate([best_score, _dot(x[i : i + 1], points[part])[0]])
                    first = np.lexsort((best_id, -best_score))[:k]
                    best_id, best_score = best_id[first], best_score[first]
                keep = best_score >= floor
                out_row.append(np.full(keep.sum(), places[i]))
                out_query.append(np.full(keep.sum(), ids[i]))
                out_id.append(best_id[keep])
                out_score.append(best_score[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in (out_row, out_query, out_id, out_score)], names=["row", "query_id", "vec_id", "score"]
            )

    return work


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = 32, query_block: int = 256, candidate_block: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, ties to the smaller vec_id.

    Both tables are (vec_id, v) of ``integer_vectors``. A query meets the vectors of its own length with another vec_id; if
    there are fewer than k, all. The pivots are the vectors with the ``pivots`` smallest key hashes. Repeated rows are
    candidates, and queries, of their own: a query that is there twice has its k answers twice. An empty table of vectors or
    queries gives no rows.
    """
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    by_size: dict[int, tuple[list, list]] = {}
    for row in chosen:
        names, points = by_size.setdefault(len(row["v"]), ([], []))
        names.append(row["vec_id"])
        points.append(row["v"])
    table = {n: (np.array(a, np.int64), np.array(b, np.int64).reshape(len(a), n)) for n, (a, b) in by_size.items()}
    schema = "vec_id long, v array<long>, table array<double>, floor long"
    numbered = F.monotonically_increasing_id().alias("row")  # a repeated vec_id is spread over the blocks like any other row
    indexed = stage(vectors.mapInArrow(_with_table(table, k), schema).select(numbered, "*"), "pivot-table")
    asked = stage(queries.mapInArrow(_with_table(table, k), schema).select(numbered, "*"), "queries")
    q_blocks = max(1, -(-asked.count() // query_block))
    c_blocks = max(1, -(-indexed.count() // candidate_block))
    row = ("row", "vec_id", "v", "table", "floor")

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(own), "row"), F.lit(own_blocks)).cast("int").alias(own)
        met = F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other)
        return df.select(block, F.size("v").alias("dim"), *row, F.lit(asks).alias("asks"), met)

    both = dealt(asked, "q_block", q_blocks, "c_block", c_blocks, True).unionByName(
        dealt(indexed, "c_block", c_blocks, "q_block", q_blocks, False)
    )
    keys = ("q_block", "c_block", "dim")
    blocks = both.select(*keys, *row, "asks").repartition(*keys).sortWithinPartitions(*keys)
    found = blocks.mapInArrow(_search(k), "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
