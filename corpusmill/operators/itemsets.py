"""Frequent items, pairs and triplets of baskets, and their contrast between two classes.

A basket is (unique_id, label, items), items sorted and distinct. Rare items are removed inside the
row before anything is paired, so the rows made from one basket are bounded by the number of
frequent items, however long the text is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import vertical
from corpusmill.operators.aggregates import count_by, having_support
from corpusmill.operators.rows import explode_values, posexplode_values
from corpusmill.sources.staging import stage

# Up to this many frequent items go into the plan as a constant; more are joined.
MAX_CONSTANT_ITEMS = 5000
# Parts that the rows of one item are dealt to when items are joined.
ITEM_PARTS = 8


def baskets(
    df: DataFrame, text: str, stopwords: Sequence[str], key: str = "unique_id", label: str | None = "label"
) -> DataFrame:
    """Item sets of raw text: (unique_id, label, items)."""
    items = tx.item_set(tx.normal_words(text), stopwords).alias("items")
    return df.select(key, *([label] if label else []), items)


def min_support(n: int, support: float) -> int:
    """Absolute support: a share below 1 becomes ceil(share * n)."""
    return math.ceil(support * n) if 0 < support < 1 else int(support)


def item_counts(baskets: DataFrame) -> DataFrame:
    """(item, cnt): baskets that contain each item."""
    return count_by(explode_values(baskets, [], "items", "item"), ["item"])


def item_residue(item: Column, buckets: int) -> Column:
    """Hash of one item: leading 32 bits of its MD5, modulo the number of buckets."""
    number = F.conv(F.substring(F.md5(item), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets))


def pair_bucket(a: Column | str, b: Column | str, buckets: int = 1000) -> Column:
    """Bucket of a pair: sum of the two item hashes modulo the number of buckets."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.pmod(item_residue(a, buckets) + item_residue(b, buckets), F.lit(buckets)).cast("int")


def _pair_histogram(residues: pa.ListArray, buckets: int) -> np.ndarray:
    """Pairs per bucket over the baskets of one Arrow column, each given by its item hashes.

    The buckets of all ordered pairs of a basket are the circular self-convolution of its hash
    histogram; taking out each item's pair with itself and halving leaves the unordered pairs.
    """
    values = residues.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(residues)), residues.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    histogram = np.bincount(row * buckets + values, minlength=len(residues) * buckets)
    histogram = histogram.reshape(len(residues), buckets).astype(np.float64)
    spectrum = np.fft.rfft(histogram, axis=1)
    ordered = np.rint(np.fft.irfft(spectrum * spectrum, n=buckets, axis=1)).astype(np.int64).sum(axis=0)
    with_itself = np.bincount(2 * values % buckets, minlength=buckets)
    return (ordered - with_itself) // 2


def bucket_counts(baskets: DataFrame, buckets: int = 1000) -> DataFrame:
    """(bucket, cnt): how many pair occurrences of the unfiltered baskets fall in each bucket.

    Counts every pair, yet makes none: the cost per basket depends on the number of buckets and
    not on the square of its length. Each task sends at most one row per bucket.
    """
    rows_at_once = max(1, 1_000_000 // buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            column = batch.column(0)
            for start in range(0, len(column), rows_at_once):
                total += _pair_histogram(column.slice(start, rows_at_once), buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["bucket", "cnt"]
        )

    hashes = F.transform("items", lambda x: item_residue(x, buckets).cast("int"))
    partial = baskets.select(hashes.alias("h")).mapInArrow(count, "bucket int, cnt long")
    return partial.groupBy("bucket").agg(F.sum("cnt").alias("cnt"))


def keep_frequent(
    baskets: DataFrame, frequent_items: DataFrame, max_constant: int = MAX_CONSTANT_ITEMS, key: str = "unique_id"
) -> DataFrame:
    """Baskets reduced to their frequent items, order kept; every basket stays, with no item if need be.

    A short list becomes a constant of the plan and the rows are filtered where they are. A long
    one is joined, and each basket is put together again by its distinct key. Both give the same rows.
    """
    if key not in baskets.columns:
        raise ValueError(f"baskets need their key {key}")
    rows = frequent_items.select("item").limit(max_constant + 1).collect()
    if len(rows) <= max_constant:
        constant = tx.string_list(sorted(r["item"] for r in rows))
        reduced = baskets.withColumn("items", F.array_intersect("items", constant))
    else:
        # A frequent item is in many baskets: its rows are dealt to parts, and its name to each part.
        part = F.pmod(F.xxhash64(key), F.lit(ITEM_PARTS)).alias("_part")
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ITEM_PARTS - 1).cast("long"))).alias("_part")
        found = explode_values(baskets, [key, part], "items", "item").join(
            frequent_items.select("item", parts), ["item", "_part"], "left_semi"
        )
        kept = found.groupBy(key).agg(F.array_sort(F.collect_list("item")).alias("_kept"))
        none = F.array().cast("array<string>")
        reduced = baskets.join(kept, key, "left").withColumn(
            "items", F.when(F.col("items").isNotNull(), F.coalesce("_kept", none))
        ).select(*baskets.columns)
    return reduced


def _tail(items: str, position: str) -> Column:
    """Elements after a 0-based position."""
    return F.slice(F.col(items), F.col(position) + 2, F.size(items) - F.col(position) - 1)


def basket_pairs(frequent_baskets: DataFrame) -> DataFrame:
    """Pairs a < b of each basket. Give it baskets reduced to frequent items."""
    others = [c for c in frequent_baskets.columns if c != "items"]
    first = posexplode_values(frequent_baskets, [*others, "items"], "items", "_pos", "a")
    return explode_values(first, [*others, "a"], _tail("items", "_pos"), "b")


def pair_counts(
    frequent_baskets: DataFrame, frequent_buckets: DataFrame | None = None, buckets: int = 1000
) -> DataFrame:
    """(a, b, cnt) of the pairs of frequent items, counted from vertical bit sets in each task.

    With ``frequent_buckets`` a pair is counted and sent only if its bucket is frequent. The buckets reach the tasks as ``buckets``
    marks, and each different item of a slice is hashed once.
    """
    if frequent_buckets is None:
        return vertical.pair_counts(frequent_baskets)
    frequent = {r["bucket"] for r in frequent_buckets.select("bucket").collect()}  # at most ``buckets`` rows
    return vertical.pair_counts(frequent_baskets, [i in frequent for i in range(buckets)])


def candidate_triplets(frequent_baskets: DataFrame, frequent_pairs: DataFrame) -> DataFrame:
    """Triplets a < b < c of each basket whose three pairs are all frequent.

    Each item is extended only by its frequent partners in the same basket, so the C(n, 3)
    triplets of a basket are never listed. ``frequent_pairs`` should be a stage table, so that its
    size is known.
    """
    others = [c for c in frequent_baskets.columns if c != "items"]
    # A stage table, so that Spark broadcasts it if it is small. Otherwise an item in many baskets is dealt to parts.
    partners = stage(frequent_pairs.groupBy("a").agg(F.collect_set("b").alias("_partners")), "partners")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ITEM_PARTS - 1).cast("long"))).alias("_part")
    first = posexplode_values(frequent_baskets, [*others, "items"], "items", "_pos", "a")
    first = first.select(*others, "a", _tail("items", "_pos").alias("_rest"))
    first = first.withColumn("_part", F.pmod(F.xxhash64("a", "_rest"), F.lit(ITEM_PARTS)))
    extended = first.join(partners.select("a", "_partners", parts), ["a", "_part"]).select(
        *others, "a", F.array_intersect("_rest", "_partners").alias("_ext")
    )
    second = posexplode_values(extended, [*others, "a", "_ext"], "_ext", "_pos", "b")
    third = explode_values(second, [*others, "a", "b"], _tail("_ext", "_pos"), "c")
    closing = frequent_pairs.select(F.col("a").alias("b"), F.col("b").alias("c"))
    return third.join(closing, ["b", "c"], "left_semi").select(*others, "a", "b", "c")


def triplet_class_counts(frequent_baskets: DataFrame, frequent_pairs: DataFrame, label: str | None = "label") -> DataFrame:
    """(a, b, c, cnt, cnt_1, cnt_0) of the candidate triplets, in total and per class at once.

    Counted from vertical bit sets while the triplets of the frequent pairs can be sent to every task, else row by row; both
    give the same rows.
    """
    known = vertical.partners(frequent_pairs)
    if known is not None:
        return vertical.triplet_counts(frequent_baskets, known, label)
    columns = [label, "items"] if label else ["items"]
    found = candidate_triplets(frequent_baskets.select(*columns), frequent_pairs)
    counts = [F.count_if(F.col(label) == i) if label else F.lit(0).cast("long") for i in (1, 0)]
    return found.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("cnt"), counts[0].alias("cnt_1"), counts[1].alias("cnt_0"))


def triplet_counts(frequent_baskets: DataFrame, frequent_pairs: DataFrame) -> DataFrame:
    """(a, b, c, cnt) of the candidate triplets."""
    return triplet_class_counts(frequent_baskets, frequent_pairs, None).select("a", "b", "c", "cnt")


def pairs_of(triplets: DataFrame) -> DataFrame:
    """The distinct pairs inside a set of triplets."""
    sides = F.explode(F.array(*[
        F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in (("a", "b"), ("a", "c"), ("b", "c"))
    ])).alias("p")
    return triplets.select(sides).select("p.a", "p.b").distinct()


def triplet_matches(baskets: DataFrame, triplets: DataFrame) -> DataFrame:
    """One row per basket and contained triplet: the other basket columns and (a, b, c).

    ``triplets`` should be a stage table.
    """
    items = triplets.select(F.explode(F.array("a", "b", "c")).alias("item")).distinct()
    found = candidate_triplets(keep_frequent(baskets, items), pairs_of(triplets))
    return found.join(triplets.select("a", "b", "c"), ["a", "b", "c"], "left_semi")


def class_counts(matches: DataFrame, keys: Sequence[str] = ("a", "b", "c"), label: str = "label") -> DataFrame:
    """(keys, cnt_1, cnt_0): both classes in one pass."""
    return matches.groupBy(*keys).agg(
        F.count_if(F.col(label) == 1).alias("cnt_1"), F.count_if(F.col(label) == 0).alias("cnt_0")
    )


def triplet_name(a: str = "a", b: str = "b", c: str = "c") -> Column:
    return tx.itemset_to_string(F.array(a, b, c))


__all__ = [
    "basket_pairs", "baskets", "bucket_counts", "candidate_triplets", "class_counts", "having_support",
    "item_counts", "keep_frequent", "min_support", "pair_bucket", "pair_counts", "pairs_of",
    "triplet_class_counts", "triplet_counts", "triplet_matches", "triplet_name",
]
