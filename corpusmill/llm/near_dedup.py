"""Near-duplicate groups by circulant MinHash: banding, then exact Jaccard on full shingle sets.

Two permutations of the 32-bit positions make the whole signature: the first scatters the shingles, the
second, shifted circularly by 1, 2, ..., K places, gives the K coordinates. Texts with equal sets are
one class. Classes that meet in a band are compared on sketches of their signatures; what may be similar forms a
candidate group, and inside each group links are confirmed on the full sets. Only links that join two parts of a
group are returned, never all pairs; no link between parts is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.components import components
from corpusmill.llm.words import groups_of, mixed, raw_texts, shingle_set, word_hashes
from corpusmill.sources.staging import stage

ROWS = 6  # coordinates in a band
MISS = 1e-6  # chance that two sets of exactly the threshold share no band
SKETCH = 128  # coordinates, one byte each, that are compared before sets are fetched
SIGMAS = 4.5  # how far below the threshold a sketch may fall by chance
MULTIPLY_1 = 0x85EBCA6B
MULTIPLY_2 = 0xC2B2AE35


def band_count(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1


def sketch_floor(threshold: float, size: int = SKETCH) -> float:
    """Share of equal sketch bytes under which two sets are not compared."""
    return threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / size)


def signature(shingles: np.ndarray, size: int, block: int = 512) -> np.ndarray:
    """``size`` minima of the second permutation, shifted by 1 to ``size``, over the scattered shingles."""
    position = (shingles >> np.uint64(32)).astype(np.uint32)  # the first permutation is the mix of the hash
    position *= np.uint32(MULTIPLY_1)
    shifts = (np.arange(1, size + 1, dtype=np.uint32) * np.uint32(MULTIPLY_1))[:, None]
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(position), block):
        x = position[start : start + block] + shifts
        x ^= x >> np.uint32(15)
        x *= np.uint32(MULTIPLY_2)
        np.minimum(low, x.min(axis=1), out=low)
    return low


def _profile(k: int, bands: int, text_column: int) -> Callable:
    """Adds set size, digest of the set, band keys and sketch to the rows of a batch."""
    salts = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = raw_texts(batch.column(text_column))
                words, bounds = word_hashes(texts)
                sizes, digests, keys, sketches = [], [], [], []
                for i in range(len(texts)):
                    found = shingle_set(words[bounds[i] : bounds[i + 1]], k)
                    sizes.append(len(found))
                    if not len(found):
                        digests.append(None)
                        keys.append(None)
                        sketches.append(None)
                        continue
                    digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    low = signature(found, bands * ROWS)
                    band = salts.copy()
                    for column in low.reshape(bands, ROWS).T:
                        band = mixed(band + column.astype(np.uint64))
                    keys.append(band.view(np.int64))
                    sketches.append(((low[:SKETCH] * np.uint32(MULTIPLY_1)) >> np.uint32(24)).astype(np.uint8).tobytes())
                added = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                         pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
                names = [*batch.schema.names, "nd_size", "nd_digest", "nd_bands", "nd_sketch"]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return work


def _joined(size: int, similar: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """Links (x, y) that join the rows of a block as all similar pairs would.

    A row is compared with all rows. The rows outside the largest part are compared until none is left, so
    two rows that end in different parts have been compared.
    """
    label, done, links, x = np.arange(size), np.zeros(size, dtype=bool), [], 0
    while True:
        done[x] = True
        near = similar(x)
        parts, first = np.unique(label[near], return_index=True)
        other = parts != label[x]
        links += [(x, int(y)) for y in near[first[other]]]
        label[np.isin(label, parts[other])] = label[x]
        values, counts = np.unique(label, return_counts=True)
        left = np.flatnonzero((label != values[counts.argmax()]) & ~done)
        if not len(left):
            return links
        x = int(left[0])


def _block_links(similarity: Callable[[list[bytes]], Callable[[int], np.ndarray]]) -> Callable:
    """Links of blocks: columns block_1, block_2, node, payload, sorted by the two keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for block in groups_of(batches, 2):
            if block.num_rows < 2:
                continue
            nodes = block.column("node").to_numpy()
            _, first = np.unique(nodes, return_index=True)
            payload = block.column("payload").take(pa.array(first)).cast(pa.binary()).to_pylist()
            nodes = nodes[first]
            for x, y in _joined(len(nodes), similarity(payload)):
                u.append(int(nodes[x]))
                v.append(int(nodes[y]))
            if len(u) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return work


def _sketch_similarity(floor: float) -> Callable:
    def prepare(payload: list[bytes]) -> Callable[[int], np.ndarray]:
        table = np.frombuffer(b"".join(payload), dtype=np.uint8).reshape(len(payload), -1)
        need = math.ceil(floor * table.shape[1])

        def similar(x: int) -> np.ndarray:
            hit = np.count_nonzero(table == table[x], axis=1) >= need
            hit[x] = False
            return np.flatnonzero(hit)

        return similar

    return prepare


def _set_similarity(k: int, percent: int) -> Callable:
    def prepare(payload: list[bytes]) -> Callable[[int], np.ndarray]:
        words, bounds = word_hashes(payload)
        sets = [shingle_set(words[bounds[i] : bounds[i + 1]], k) for i in range(len(payload))]
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]

        def similar(x: int) -> np.ndarray:
            low, high = np.searchsorted(every, sets[x], side="left"), np.searchsorted(every, sets[x], side="right")
            length = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            hit = 100 * both >= percent * (sizes + sizes[x] - both)
            hit[x] = False
            return np.flatnonzero(hit)

        return similar

    return prepare


def linked(members: DataFrame, similarity: Callable, size: int) -> DataFrame:
    """(u, v): links inside groups (grp, node, payload), as many as join what similar pairs would join.

    A group of more than ``size`` rows is dealt to parts by a hash of the node, and every two parts meet
    in a block: a task holds two parts whatever the size of the group.
    """
    counts = stage(members.groupBy("grp").agg(F.ceil(F.count("*") / size).cast("int").alias("parts")), "group-sizes")
    part = F.pmod(F.xxhash64(F.lit(7), "node"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("part"))
    pairs = F.transform(others, lambda j: F.least("part", j).cast("long") * (1 << 31) + F.greatest("part", j))
    blocks = members.join(counts, "grp").withColumn("part", part).select(
        F.col("grp").alias("block_1"),
        F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("block_2"),
        "node", "payload",
    )
    dealt = blocks.repartition("block_1", "block_2").sortWithinPartitions("block_1", "block_2")
    return dealt.mapInArrow(_block_links(similarity), "u long, v long")


def _candidates(profile: DataFrame, classes: DataFrame, floor: float, block: int) -> DataFrame:
    """(node, component): classes that a chain of similar sketches joins, through shared bands."""
    nodes = classes.select("node")
    bands = stage(profile.select("nd_row", "nd_bands").join(nodes, F.col("nd_row") == F.col("node")).select("node", "nd_bands"), "bands")
    exploded = bands.select(F.explode("nd_bands").alias("grp"), "node")
    met = exploded.groupBy("grp").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.sum(F.xxhash64("node") % (1 << 50)).alias("mark"),
    ).where("n > 1")
    # Bands that hold the same classes are one group.
    met = stage(met.groupBy("n", "a", "b", "mark").agg(F.min("grp").alias("grp")), "met")
    two = met.where("n = 2").select("grp", F.explode(F.array("a", "b")).alias("node"))
    more = exploded.join(met.where("n > 2").select("grp"), "grp").select("grp", "node")
    sketches = profile.select(F.col("nd_row").alias("node"), F.col("nd_sketch").alias("payload"))
    return components(linked(two.unionByName(more).join(sketches, "node"), _sketch_similarity(floor), block))


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80,
    sketch_block: int = 1024, set_block: int = 512,
) -> DataFrame:
    """The columns of ``docs`` and n_shingles, component_id, kept, first: near-duplicate groups of whole texts.

    Two texts are linked when 100 * |intersection| >= ``percent`` * |union| of their sets of ``k``-word
    shingles. A text of fewer words is one shingle. A text that is null or has no word is linked with
    nothing and is its own group. ``component_id`` is the smallest ``key`` of the group; rows with that key have
    ``kept``, and so have all rows of a group without any key. Repeated rows are one group; each of them is ``kept`` if it
    has the smallest key, but only one row of a group is ``first``. Columns that already have a name of the result are replaced,
    all others are kept whatever their names. An empty table gives an empty result.
    """
    docs = docs.drop("n_shingles", "component_id", "kept", "first")
    # The caller's columns go by their places until the result, so that no name is taken.
    names = docs.columns
    text, key = (f"own_{names.index(c)}" for c in (text, key))
    docs = docs.toDF(*[f"own_{i}" for i in range(len(names))])
    bands = band_count(percent / 100)
    floor = sketch_floor(percent / 100, min(SKETCH, bands * ROWS))
    rows = docs.withColumn("nd_row", F.monotonically_increasing_id())
    schema = T.StructType([
        *rows.schema.fields, T.StructField("nd_size", T.LongType()), T.StructField("nd_digest", T.BinaryType()),
        T.StructField("nd_bands", T.ArrayType(T.LongType())), T.StructField("nd_sketch", T.BinaryType()),
    ])
    profile = stage(rows.mapInArrow(_profile(k, bands, docs.columns.index(text)), schema), "profile")
    own = F.col(key)
    classes = profile.where("nd_digest is not null").groupBy("nd_digest")
    # The smallest key, null last, and of the rows that have it the first.
    classes = stage(classes.agg(F.min("nd_row").alias("node"), F.min(F.struct(own.isNull().alias("no_key"), own.alias("key"), F.col("nd_row").alias("row"))).alias("least")), "classes")

    found = stage(_candidates(profile, classes, floor, sketch_block), "candidates")
    texts = profile.select(F.col("nd_row").alias("node"), F.col(text).alias("payload"))
    members = found.withColumnRenamed("component", "grp").join(texts, "node")
    confirmed = stage(components(linked(members, _set_similarity(k, percent), set_block)), "confirmed")

    rooted = classes.join(confirmed, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("nd_least")), "least")
    of_class = rooted.select("nd_digest", "root").join(least, "root").select("nd_digest", "nd_least")
    joined = profile.join(stage(of_class, "of-class"), "nd_digest", "left")
    alone = F.col("nd_digest").isNull()
    component = F.when(alone, own).otherwise(F.col("nd_least.key"))
    return joined.select(
        *[F.col(c).alias(name) for c, name in zip(docs.columns, names, strict=True)], F.col("nd_size").alias("n_shingles"),
        component.alias("component_id"), own.eqNullSafe(component).alias("kept"),
        (alone | (F.col("nd_row") == F.col("nd_least.row"))).alias("first"),
    )
