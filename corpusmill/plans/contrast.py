"""Mine frequent triplets and contrast their counts between two classes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from corpusmill.operators import itemsets as it
from corpusmill.operators.aggregates import having_support, topk_contrast
from corpusmill.sources.staging import stage


class FirstPass(NamedTuple):
    baskets: DataFrame  # reduced to frequent items
    items: DataFrame
    n: int  # baskets


class Mined(NamedTuple):
    baskets: DataFrame  # reduced to frequent items
    items: DataFrame
    pairs: DataFrame
    triplets: DataFrame  # (a, b, c, cnt, cnt_1, cnt_0)


def first_pass(baskets: DataFrame, support: float) -> FirstPass:
    """Frequent items, and the baskets reduced to them. The texts are read and split once."""
    baskets = stage(baskets, "baskets")
    n = baskets.count()
    items = stage(having_support(it.item_counts(baskets), it.min_support(n, support)), "frequent-items")
    return FirstPass(stage(it.keep_frequent(baskets, items), "frequent-baskets"), items, n)


def second_pass(first: FirstPass, support: float) -> DataFrame:
    """Frequent pairs, as a stage table."""
    counts = it.pair_counts(first.baskets)
    return stage(having_support(counts, it.min_support(first.n, support)), "frequent-pairs")


def triplet_counts(first: FirstPass, pairs: DataFrame, label: str = "label") -> DataFrame:
    """(a, b, c, cnt, cnt_1, cnt_0) of the candidate triplets: in total and per class at once."""
    return it.triplet_class_counts(first.baskets, pairs, label)


def third_pass(first: FirstPass, pairs: DataFrame, support: float, label: str = "label") -> DataFrame:
    """Frequent triplets, as a stage table."""
    counts = triplet_counts(first, pairs, label)
    return stage(having_support(counts, it.min_support(first.n, support)), "frequent-triplets")


def mine(
    baskets: DataFrame, item_support: float, pair_support: float, triplet_support: float, label: str = "label"
) -> Mined:
    """All passes; supports are absolute, or a share of the baskets when below 1."""
    first = first_pass(baskets, item_support)
    pairs = second_pass(first, pair_support)
    return Mined(first.baskets, first.items, pairs, third_pass(first, pairs, triplet_support, label))


def triplet_class_counts(mined: Mined) -> DataFrame:
    """(triplet, cnt_1, cnt_0) of the frequent triplets."""
    return mined.triplets.select(it.triplet_name().alias("triplet"), "cnt_1", "cnt_0")


def triplet_contrast(mined: Mined, n: int = 10) -> DataFrame:
    """The ``n`` triplets with the largest lead of class 1, with both counts and the difference."""
    return topk_contrast(triplet_class_counts(mined), n)
