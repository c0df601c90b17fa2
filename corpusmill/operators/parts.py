"""Texts dealt to parts of bounded size, each with the rows of its own words only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from corpusmill.operators.rows import explode_values

PART = "_part"
FEW = 8  # parts that a corpus is dealt to before they grow


def parts_for(df: DataFrame, tokens: str, least: int, most: int) -> int:
    """Number of parts of about ``least`` words each; from ``FEW`` parts on they grow to ``most`` words before there are more.

    The rare words of a corpus are in nearly as many parts as they have places, so what the parts hold together falls with their number.
    """
    total = df.agg(F.sum(F.greatest(F.size(tokens), F.lit(0)))).first()[0] or 0
    return max(1, -(-total // min(max(least, -(-total // FEW)), max(least, most))))


def part_numbers(spark: SparkSession, parts: int) -> list[int]:
    """Numbers of parts that Spark's hash puts into ``parts`` partitions, one in each; 0 for a single part."""
    if parts == 1:
        return [0]
    found: dict[int, int] = {}
    tried = 32 * parts
    while len(found) < parts:
        number = F.col("id").cast("int")
        rows = spark.range(tried).groupBy(F.pmod(F.hash(number), F.lit(parts)).alias("at")).agg(F.min(number).alias("n")).collect()
        found, tried = {r["at"]: r["n"] for r in rows}, 2 * tried
    return sorted(found.values())


def dealt(df: DataFrame, tokens: str, parts: int, key: str) -> DataFrame:
    """``df`` with the number of each row's part. Copies of a text go to different parts by their keys."""
    by = [c for c in (key, tokens) if c in df.columns]
    numbers = F.array(*[F.lit(n) for n in part_numbers(df.sparkSession, parts)])
    return df.withColumn(PART, F.get(numbers, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")))


def words_of_parts(texts: DataFrame, tokens: str) -> DataFrame:
    """(part, word): the distinct words of each part."""
    return explode_values(texts, [PART], F.array_distinct(tokens), "word").distinct()


def packed(texts: DataFrame, key: str, tokens: str) -> DataFrame:
    """(part, pack): the keys and tokens of several texts of a part as one compressed value."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            part = batch.column(0).to_numpy()
            order = np.argsort(part, kind="stable")
            ends = np.flatnonzero(np.diff(part[order], append=-1)) + 1
            for begin, end in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
                own = batch.take(pa.array(order[begin:end])).select([1, 2])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[order[begin]]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=[PART, "_pack"])

    return texts.select(PART, F.col(key).alias("_key"), F.col(tokens).alias("_tokens")).mapInArrow(work, f"{PART} int, _pack binary")


def unpacked(packs: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    """The batches (_key, _tokens) of ``packed``."""
    for pack in packs:
        with pa.ipc.open_stream(pack.as_buffer()) as batches:
            yield from batches


def places(tokens: pa.ListArray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The place among ``words`` of each known token, in order, and how many known tokens each text has."""
    found = pc.index_in(tokens.flatten(), words)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(tokens).fill_null(0).to_numpy()
    before = np.append(0, np.cumsum(known))
    ends = np.cumsum(lengths)
    return found.drop_null().to_numpy(), before[ends] - before[ends - lengths]


def side_by_side(texts: DataFrame, own: DataFrame, parts: int) -> PandasCogroupedOps:
    """The two tables cogrouped by part; repartitioned by number, so that small parts are not put together in one task."""
    renamed = own.withColumn(f"{PART}_of_own", F.col(PART) + F.lit(0)).drop(PART)
    left, right = texts.repartition(parts, PART).groupBy(PART), renamed.repartition(parts, f"{PART}_of_own").groupBy(f"{PART}_of_own")
    return left.cogroup(right)
