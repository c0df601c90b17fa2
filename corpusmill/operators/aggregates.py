"""Counts, modes, means and set operations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.parts import PART, dealt, packed, parts_for, places, side_by_side, unpacked, words_of_parts

# Words of the texts of one part when word vectors are averaged: of a small corpus, and of any, for vectors of 400 bytes or less.
WORDS_PER_PART = 500_000
MOST_WORDS_PER_PART = 4_000_000
# Values of word vectors that are added up at once.
VALUES = 1 << 21


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence = (0, 1), prefix: str = "n_") -> DataFrame:
    """Contingency table: one row per value of ``rows``, one count column per listed value.

    A value that is not listed fails the job; missing values are in no column.
    """
    failure = F.raise_error(F.concat(F.lit(f"not a listed value of {columns}: "), F.col(columns).cast("string")))
    value = F.when(F.col(columns).isNull() | F.col(columns).isin(list(values)), F.col(columns)).otherwise(failure)
    return df.groupBy(rows).agg(*[F.count_if(value == F.lit(v)).alias(f"{prefix}{v}") for v in values])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, cnt) by falling count; missing values are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), column)


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value; a tie goes to the smallest."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    order = F.struct(-F.col("cnt"), F.col(column))
    return counts.agg(F.min_by(column, order).alias(column), F.max("cnt").alias("cnt"))


def mode_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """(group, value): the most frequent value of each group; a tie goes to the smallest."""
    counts = df.where(F.col(column).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("cnt"))
    order = F.struct(-F.col("cnt"), F.col(column))
    return counts.groupBy(group).agg(F.min_by(column, order).alias(column))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    """Rows per key. Spark counts inside each task first and merges the counters by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def having_support(counts: DataFrame, support: int, count: str = "cnt") -> DataFrame:
    """Groups that reach the support, inclusive."""
    return counts.where(F.col(count) >= F.lit(support))


def mean_scores(scores: DataFrame, score: str = "score") -> DataFrame:
    """One row: mean of the fold scores."""
    return scores.agg(F.avg(score).alias("mean_score"))


def _part_means() -> Callable:
    """Rows (key, mean, number) of the texts of one part that have a known word, from the vectors of the part's words."""

    def work(texts: pa.Table, own: pa.Table) -> pa.Table:
        if own.column("vector").null_count:
            own = own.filter(own.column("vector").is_valid())
        words = own.column("word").unique()
        chunks = [c.flatten().to_numpy(zero_copy_only=False) for c in own.column("vector").chunks]
        size = sum(map(len, chunks)) // own.num_rows if own.num_rows else 0
        values = np.concatenate(chunks).reshape(own.num_rows, size) if own.num_rows else np.zeros((0, 0))
        repeats = np.ones(len(words), np.int64)
        if len(words) < own.num_rows:
            at = pc.index_in(own.column("word"), words).to_numpy()
            sums, repeats = np.zeros((len(words), size)), np.bincount(at, minlength=len(words))
            np.add.at(sums, at, values)
            values = sums
        else:
            words = own.column("word").combine_chunks()
        schema = None
        batches = []
        for batch in unpacked(texts.column("_pack")):
            found, lengths = places(batch.column(1), words)
            rows = np.flatnonzero(lengths)
            begins = (np.cumsum(lengths) - lengths)[rows]
            means, counts = np.zeros((len(rows), size)), np.zeros(len(rows), np.int64)
            if len(rows):
                counts = np.add.reduceat(repeats[found], begins)
            step = max(1, VALUES // max(1, size))
            for low in range(0, len(found), step):
                part = found[low : low + step]
                first = int(np.searchsorted(begins, low, side="right")) - 1
                last = int(np.searchsorted(begins, low + len(part)))
                means[first:last] += np.add.reduceat(values[part].astype(float), np.maximum(begins[first:last] - low, 0), axis=0)
            means /= np.maximum(counts, 1)[:, None]
            mean = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * size, pa.int32()), pa.array(means.ravel(), pa.float64()))
            found_batch = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), mean, pa.array(counts, pa.int64())], names=["_key", "_mean", "_n"])
            schema = found_batch.schema
            batches.append(found_batch)
        return pa.Table.from_batches(batches, schema)

    return work


def vector_mean(
    df: DataFrame, tokens: str, vectors: DataFrame, size: int, key: str = "unique_id", out: str = "embedding"
) -> DataFrame:
    """(key, out): mean of the word vectors of each row, over known words only; none gives zeros.

    ``vectors`` is (word, vector ARRAY<DOUBLE> or ARRAY<FLOAT>). Texts are dealt to parts; the vectors of a part's distinct words are sent to it, so
    what is sent does not grow with the repeats of a word, and a part's vectors fit in a task.
    """
    kind_of_vectors = vectors.schema["vector"].dataType.simpleString()
    if kind_of_vectors != "array<float>":
        kind_of_vectors = "array<double>"
    share = min(1, 400 / (size * (4 if kind_of_vectors == "array<float>" else 8)))
    parts = parts_for(df, tokens, WORDS_PER_PART, int(MOST_WORDS_PER_PART * share))
    texts = dealt(df.select(F.col(key).alias("_key"), F.col(tokens).alias("_tokens")), "_tokens", parts, "_key")
    own = words_of_parts(texts, "_tokens").join(vectors.select("word", F.col("vector").cast(kind_of_vectors).alias("vector")), "word")
    kind = df.schema[key].dataType.simpleString()
    texts = packed(texts, "_key", "_tokens")
    found = side_by_side(texts, own.select(PART, "word", "vector"), parts).applyInArrow(_part_means(), f"_key {kind}, _mean array<double>, _n long")
    mean = Summarizer.mean(array_to_vector("_mean"), F.col("_n").cast("double"))  # of all rows with one key
    means = found.groupBy(F.col("_key").alias(key)).agg(vector_to_array(mean).alias("_mean"))
    zeros = F.array_repeat(F.lit(0.0), size)
    joined = df.select(key).join(means, key, "left")
    return joined.select(key, F.coalesce("_mean", zeros).alias(out))


def union_all(*frames: DataFrame) -> DataFrame:
    """Row concatenation by column name; a missing column is filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def topk_contrast(counts: DataFrame, n: int = 10, key: str = "triplet") -> DataFrame:
    """Keys with the largest lead of class 1 over class 0; ties by name."""
    difference = F.col("cnt_1") - F.col("cnt_0")
    return counts.withColumn("difference", difference).orderBy(F.desc("difference"), key).limit(n)


def argmax_param(results: DataFrame, param: str = "param", score: str = "value") -> DataFrame:
    """One row: the parameter with the best score; the first wins a tie."""
    return results.orderBy(F.desc(score), param).limit(1)
