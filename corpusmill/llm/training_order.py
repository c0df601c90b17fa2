"""Training-order materialisation: sequences at keyed random places of fixed-stride shards.

Texts are cut into sequences of a fixed number of tokens. Sequence i of N goes to slot P(i), where P is a keyed Feistel permutation of the
next even power of two, walked along its cycle until it falls below N; so every slot from 0 to N - 1 is taken once. Shard s holds
the slots from s * per_shard on, each at (slot - s * per_shard) * stride bytes: any slot can be found by its number, and a
reader that stopped goes on from there.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.words import groups_of, mixed
from corpusmill.sources.staging import stage

ROUNDS = 6
BYTE_END, BYTE_PAD = 255, 254  # UTF-8 has neither
SHARD_BYTES = 16 << 20


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of ``index`` under the keyed permutation of 0 .. n - 1."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mixed(np.uint64(key & (2**64 - 1)) + np.arange(1, ROUNDS + 1, dtype=np.uint64))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def sequence_count(tokens: np.ndarray | int, length: int):
    """Sequences of a text with so many tokens: they and one end, cut by ``length``."""
    return tokens // length + 1


def _cut(counts: dict[int, tuple[int, int]], column: int, n: int, length: int, kind: str, end: int, pad: int, key: int,
         per_shard: int) -> Callable:
    """Sequences of a task's rows with their slots. ``counts``: of each partition, the first number and how many."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        at, expected = counts.get(partition, (0, 0))
        stop, width = at + expected, np.dtype(kind).itemsize
        last = np.array([end], dtype=kind).tobytes()
        filler = np.array([pad], dtype=kind).tobytes()
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                rows, chunks, payload = [], [], []
                for i, tokens in enumerate(batch.column(column)):
                    if isinstance(tokens, pa.ListScalar):
                        values = tokens.values
                        data = (b"" if values is None else values.to_numpy(zero_copy_only=False).astype(kind).tobytes()) + last
                    else:
                        data = (tokens.as_py() or b"") + last
                    for k in range(0, len(data), length * width):
                        rows.append(i)
                        chunks.append(k // (length * width))
                        part = data[k : k + length * width]
                        part += filler * ((length * width - len(part)) // width)
                        payload.append(zlib.compress(part, 1))  # smaller in the shuffle; shards hold it as it is
                slots = permuted(np.arange(at, at + len(rows)), n, key) if rows else np.zeros(0, np.int64)
                at += len(rows)
                if at > stop:
                    raise RuntimeError("the rows came in other partitions than when they were counted; stage them first")
                keep = [j for j in range(batch.num_columns) if j != column]
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(j).take(taken) for j in keep], pa.array(chunks, pa.int32()), pa.array(slots),
                     pa.array((slots // per_shard).astype(np.int32)), pa.array(payload, pa.binary())],
                    names=[*[batch.schema.names[j] for j in keep], "chunk", "slot", "shard", "payload"],
                )
        if at != stop:
            raise RuntimeError("the rows came in other partitions than when they were counted; stage them first")

    return work


def _write(out: str) -> Callable:
    """Writes each shard of a task to a file of its own name, by an atomic rename; tells where each sequence is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(out)
        for block in groups_of(batches, 1):
            shard = block.column("shard")[0].as_py()
            slots = block.column("slot").to_numpy()
            if (np.diff(slots) != 1).any():
                raise RuntimeError(f"shard {shard} misses a slot or has it twice")
            trial, final = f"{folder}/_{shard}-{uuid.uuid4().hex}", f"{folder}/{shard_name(shard)}"
            stride = 0
            with system.open_output_stream(trial) as file:
                for part in block.column("payload").chunks:
                    for record in part:
                        data = zlib.decompress(record.as_buffer())
                        stride = len(data)
                        file.write(data)
            system.move(trial, final)
            for part in block.drop_columns(["payload"]).to_batches(max_chunksize=10_000):
                at = (part.column("slot").to_numpy() - slots[0]) * stride
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at)], names=[*part.schema.names, "offset"])

    return work


def materialise(
    rows: DataFrame, tokens: str, out: str, length: int = 512, kind: str = "uint8", end: int = BYTE_END, pad: int = BYTE_PAD,
    key: int = 0, per_shard: int | None = None, stable: bool = False,
) -> tuple[DataFrame, int]:
    """Write all rows' tokens under ``out``; returns where each sequence is, and their number.

    ``tokens`` is binary (one byte a token, ``kind`` uint8) or an array of integers. A null or empty text is one sequence of
    its end. The table has the other columns, chunk, slot, shard and offset. The folder must be one that pyarrow and all executors reach
    by the same name. Rows are numbered by partition, counted first and checked when written; unless they are read straight
    from files (``stable``), they are staged before. A task that is run again writes the same shard again.
    """
    if not stable:
        rows = stage(rows, "sequences")
    rows = rows.drop("chunk", "slot", "shard", "offset", "payload")
    width = np.dtype(kind).itemsize
    per_shard = per_shard or max(1, SHARD_BYTES // (length * width))
    field = rows.schema[tokens]
    size = F.octet_length(F.col(f"`{tokens}`")) if isinstance(field.dataType, T.BinaryType) else F.size(F.col(f"`{tokens}`"))
    parts = F.floor(F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)) / length) + 1
    counted = rows.select(F.spark_partition_id().alias("p"), parts.alias("n")).groupBy("p").agg(F.sum("n").alias("n"))
    counts, n = {}, 0
    for r in sorted(counted.collect(), key=lambda r: r["p"]):  # one row per partition of the input
        counts[r["p"]] = (n, r["n"])
        n += r["n"]
    others = [f for f in rows.schema.fields if f.name != tokens]
    placed = [T.StructField("chunk", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())]
    work = _cut(counts, rows.columns.index(tokens), n, length, kind, end, pad, key, per_shard)
    cut = rows.mapInArrow(work, T.StructType([*others, *placed, T.StructField("payload", T.BinaryType())]))
    shards = max(1, -(-n // per_shard))
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(out)
    system.create_dir(folder, recursive=True)
    ordered = cut.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
    names = ["shard", *[f"`{f.name}`" for f in others], "chunk", "slot", "payload"]
    told = T.StructType([placed[2], *others, *placed[:2], T.StructField("offset", T.LongType())])
    index = stage(ordered.select(*names).mapInArrow(_write(out), told), "training-order")
    return index, n


def read_back(index: DataFrame, out: str, stride: int) -> DataFrame:
    """The index and each sequence's bytes, read from its place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(out)
        shard, file = None, None
        for batch in batches:
            data = []
            for s, at in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                if s != shard:
                    shard, file = s, system.open_input_file(f"{folder}/{shard_name(s)}")
                data.append(file.read_at(stride, at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, "payload"])

    return index.mapInArrow(work, T.StructType([*index.schema.fields, T.StructField("payload", T.BinaryType())]))
