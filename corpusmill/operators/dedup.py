"""De-duplication by text.

A text may be copied into a large share of all rows, so no row is ever sent to "its" text. Copies
are counted by an aggregation on a digest, which collapses inside each task first; the outcome is
joined back by the row key, which is distinct and therefore spread evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import word_count
from corpusmill.operators.ranks import assign_row_key
from corpusmill.sources.staging import stage


def digest(column: str) -> Column:
    """SHA-256 of a text as 32 bytes; stands for the text in shuffles."""
    return F.unhex(F.sha2(F.col(column), 256))


def checked_keys(df: DataFrame, text: str, order_by: str) -> DataFrame:
    """``df`` when no ``order_by`` is NULL or has two texts; raises otherwise. One aggregation over narrow rows."""
    same = F.min(digest(text)).eqNullSafe(F.max(digest(text))) & (F.count_if(F.col(text).isNull()).isin(0) | F.min(digest(text)).isNull())
    bad = df.groupBy(order_by).agg(same.alias("same")).where(~F.col("same") | F.col(order_by).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"{order_by} must be distinct and not NULL; see {bad[0][order_by]}")
    return df


def first_rows(df: DataFrame, text: str = "body", order_by: str = "row_id") -> DataFrame:
    """(order_by, n_copies): the first row of each text and the number of its copies.

    ``order_by`` is distinct and not NULL. Missing texts count as equal.
    """
    return (
        df.groupBy(digest(text).alias("_digest"))
        .agg(F.min(order_by).alias(order_by), F.count(F.lit(1)).alias("n_copies"))
        .drop("_digest")
    )


def _with_copies(df: DataFrame, text: str, order_by: str) -> DataFrame:
    """``n_copies`` on the first row of each text, NULL on later copies."""
    return df.join(first_rows(df, text, order_by), order_by, "left")


def duplicate_flag(df: DataFrame, text: str = "body", order_by: str = "row_id") -> DataFrame:
    """``is_duplicate`` on all members of a repeated text, the first one included."""
    flagged = _with_copies(checked_keys(df, text, order_by), text, order_by)
    # A later copy always has a first row beside it, so it needs no count of its own.
    is_duplicate = F.col("n_copies").isNull() | (F.col("n_copies") > 1)
    return flagged.withColumn("is_duplicate", is_duplicate).drop("n_copies")


def dedup_short_long_split(
    df: DataFrame, text: str = "body", order_by: str = "row_id", max_words: int = 5
) -> DataFrame:
    """The duplicates only, each marked ``short`` or ``long`` by its number of words."""
    duplicates = duplicate_flag(df, text, order_by).where("is_duplicate").drop("is_duplicate")
    counted = duplicates.withColumn("word_count", word_count(text))
    return counted.withColumn("kind", F.when(F.col("word_count") <= max_words, "short").otherwise("long"))


def dedup_keep_first(df: DataFrame, text: str = "body", order_by: str = "row_id") -> DataFrame:
    """First row of each text."""
    checked_keys(df, text, order_by)
    return df.join(first_rows(df, text, order_by).select(order_by), order_by, "left_semi")


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop rows that are equal in every column."""
    return df.distinct()


def dedup_length_aware(
    df: DataFrame, text: str = "body", order_by: str = "row_id", max_words: int = 5, key: str = "unique_id"
) -> DataFrame:
    """Keep unique texts, all copies of short texts, and the first copy of long ones; add a key.

    Key order: unique and short rows in source order, then the survivors of the long ones. All
    decisions use a narrow table of row keys; the wide rows are shuffled once, by ``order_by``. A row
    key that is NULL or has two texts fails the job.
    """
    checked_keys(df, text, order_by)
    narrow = df.select(
        order_by, digest(text).alias("_digest"), (word_count(text) <= max_words).alias("_short")
    )
    firsts = narrow.groupBy("_digest").agg(
        F.min(order_by).alias(order_by), F.count(F.lit(1)).alias("n_copies")
    ).drop("_digest")
    kept = narrow.drop("_digest").distinct().join(firsts, order_by, "left")
    kept = kept.where(F.col("_short") | F.col("n_copies").isNotNull())
    survivor = ~F.col("_short") & (F.col("n_copies") > 1)
    kept = stage(kept.select(order_by, survivor.cast("int").alias("_survivor")), "kept-rows")
    keys = assign_row_key(kept, order_by, key, lead=["_survivor"]).drop("_survivor")
    # Same rows under one row key are equal in every column; the join has brought them together.
    return df.join(keys, order_by).select(*df.columns, key).distinct()
