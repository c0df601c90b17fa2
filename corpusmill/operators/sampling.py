"""Balancing, splitting and folding by a hash of the row key.

No generator state is involved: the same rows come out for any partitioning and after any retry.
Row keys must be distinct. Only class sizes and cut rows reach the driver; the wide rows are
filtered in place and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.staging import stage
from corpusmill.operators.ranks import at_or_before, hash_cuts, hash_key, hash_rank

MAX_CLASSES = 1000


def class_sizes(df: DataFrame, label: str = "label", most: int = MAX_CLASSES) -> dict:
    """Rows per class. The driver holds one number per class, so more than ``most`` is an error, not a cut."""
    rows = df.groupBy(label).count().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"column {label} has more than {most} classes")
    return {r[label]: r["count"] for r in rows}


def _take_per_class(df: DataFrame, id_col: str, label: str, keep: dict, sizes: dict, seed: int) -> DataFrame:
    """First ``keep[c]`` rows of each class in hash order."""
    targets = [(c, 0, k) for c, k in keep.items() if 0 < k < sizes.get(c, 0)]
    cuts = {}
    if targets:
        cuts = {r[label]: r for r in hash_cuts(df, id_col, targets, label, seed)}
    chosen: Column = F.lit(False)
    for c, k in keep.items():
        if k > 0:
            in_class = F.col(label) == F.lit(c)
            chosen = chosen | (in_class & at_or_before(id_col, cuts[c], seed) if c in cuts else in_class)
    return df.where(chosen)


def balance_undersample(
    df: DataFrame, id_col: str = "unique_id", label: str = "label", classes: Sequence = (0, 1), seed: int = 42
) -> DataFrame:
    """Cut every class to the size of the smallest one, without replacement."""
    sizes = class_sizes(df, label)
    smallest = min(sizes.get(c, 0) for c in classes)
    return _take_per_class(df, id_col, label, {c: smallest for c in classes}, sizes, seed)


def balance_downsample_zero(
    df: DataFrame, id_col: str = "unique_id", label: str = "label", seed: int = 42
) -> DataFrame:
    """Cut class 0 to the size of class 1; class 0 must be the larger one."""
    sizes = class_sizes(df, label)
    zeros, ones = sizes.get(0, 0), sizes.get(1, 0)
    if zeros < ones:
        raise ValueError(f"class 0 has {zeros} rows, fewer than the {ones} rows of class 1")
    return _take_per_class(df, id_col, label, {0: ones, 1: ones}, sizes, seed)


def shuffle_rows(df: DataFrame, id_col: str = "unique_id", seed: int = 42) -> DataFrame:
    """Position of each row in a random but repeatable order; sort by it only on export."""
    return hash_rank(df, id_col, seed=seed, out="position")


def _split_by_rank(df: DataFrame, id_col: str, bounds: list[int], names: list[str], n: int, seed: int) -> DataFrame:
    """Label rows by which of the ascending rank ``bounds`` they fall under."""
    wanted = [(None, i, b) for i, b in enumerate(bounds) if 0 < b < n]
    cuts = {r["cut"]: r for r in hash_cuts(df, id_col, wanted, seed=seed)} if wanted else {}
    out = F.when(F.lit(False), F.lit(names[-1]))
    for i, b in enumerate(bounds):
        if b >= n:
            out = out.when(F.lit(True), F.lit(names[i]))
        elif b > 0:
            out = out.when(at_or_before(id_col, cuts[i], seed), F.lit(names[i]))
    return df.withColumn("split", out.otherwise(F.lit(names[-1])))


def split_holdout(
    df: DataFrame, id_col: str = "unique_id", test_size: float = 0.3, seed: int = 42
) -> DataFrame:
    """``split`` is ``train`` or ``test``; the test part has ceil(test_size * n) rows."""
    n = df.count()
    train = n - math.ceil(test_size * n)
    return _split_by_rank(df, id_col, [train], ["train", "test"], n, seed)


def split_train_val_test(
    df: DataFrame, id_col: str = "unique_id", rest_size: float = 0.3, test_share: float = 0.5, seed: int = 42
) -> DataFrame:
    """``split`` is ``train``, ``val`` or ``test``, with sizes as two successive hold-out cuts give."""
    n = df.count()
    rest = math.ceil(rest_size * n)
    test = math.ceil(test_share * rest)
    return _split_by_rank(df, id_col, [n - rest, n - test], ["train", "val", "test"], n, seed)


def split_and_balance(
    df: DataFrame, id_col: str = "unique_id", label: str = "label", balance: str = "train", seed: int = 42
) -> DataFrame:
    """Train/validation/test split with balancing.

    ``balance``: ``train`` splits first and balances the training part only (the default);
    ``before`` balances everything, then splits; ``both`` balances everything, splits, and
    balances the training part again; ``none`` only splits.
    """
    if balance not in ("train", "before", "both", "none"):
        raise ValueError(f"unknown balance mode {balance}")
    # All decisions are taken on one narrow stage table; the wide rows are read once, when they are joined.
    rows = stage(df.select(id_col, label), "keys-and-labels")
    if balance in ("before", "both"):
        rows = balance_undersample(rows, id_col, label, seed=seed)
    parts = split_train_val_test(rows, id_col, seed=seed)
    if balance in ("train", "both"):
        train = balance_undersample(parts.where(F.col("split") == "train"), id_col, label, seed=seed)
        parts = train.unionByName(parts.where(F.col("split") != "train"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.join(parts.select(id_col, "split"), id_col).select(*columns, "split")


def stratified_kfold(
    df: DataFrame, id_col: str = "unique_id", label: str = "label", folds: int = 10, seed: int = 42
) -> DataFrame:
    """``fold`` 0..folds-1, every class spread so that fold sizes differ by at most one. Labels must not be NULL."""
    sizes = class_sizes(df, label)
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have no {label}")
    wanted = [
        (c, f, n * (f + 1) // folds)
        for c, n in sizes.items() for f in range(folds - 1) if 0 < n * (f + 1) // folds < n
    ]
    cuts = hash_cuts(df, id_col, wanted, label, seed) if wanted else []
    fold = F.when(F.lit(False), F.lit(0))
    for c, n in sizes.items():
        in_class = F.when(F.lit(False), F.lit(0))
        own = {r["cut"]: r for r in cuts if r[label] == c}
        for f in range(folds - 1):
            if f in own:
                in_class = in_class.when(at_or_before(id_col, own[f], seed), F.lit(f))
            elif n * (f + 1) // folds >= n > 0:
                in_class = in_class.when(F.lit(True), F.lit(f))
        fold = fold.when(F.col(label) == F.lit(c), in_class.otherwise(F.lit(folds - 1)))
    return df.withColumn("fold", fold)


def union_train_val(parts: DataFrame) -> DataFrame:
    """Training and validation rows together, for the final fit."""
    train = parts.where(F.col("split") == "train")
    return train.unionByName(parts.where(F.col("split") == "val"))


__all__ = [
    "balance_downsample_zero", "balance_undersample", "class_sizes", "hash_key", "shuffle_rows",
    "split_and_balance", "split_holdout", "split_train_val_test", "stratified_kfold", "union_train_val",
]
