"""Raw posts to the final corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import collapse_whitespace
from corpusmill.operators import clean
from corpusmill.operators.dedup import dedup_length_aware

# Categories of the final corpus.
CATEGORIES = ("DeepThoughts", "teenagers", "SuicideWatch", "depression", "happy")


def clean_posts(raw: DataFrame) -> DataFrame:
    """Usable rows of the raw table with their types put right."""
    rows = clean.drop_null_subset(raw, ["body"])
    rows = clean.filter_nonblank(rows, "body")
    rows = clean.drop_null_subset(rows, ["row_id"])
    rows = clean.drop_all_null(rows, ignore=["subreddit", "row_id"])
    rows = clean.fill_null(rows, "num_comments", 0)
    rows = clean.cast_nullable_int(rows, ["upvotes", "num_comments", "label"])
    return clean.epoch_to_timestamp(rows, "created_utc", "created_datetime")


def keyed_posts(raw: DataFrame, max_words: int = 5) -> DataFrame:
    """Cleaned, de-duplicated posts with ``unique_id`` and single spaces in the text."""
    posts = dedup_length_aware(clean_posts(raw), "body", "row_id", max_words, "unique_id")
    return posts.withColumn("body", collapse_whitespace("body"))


def final_corpus(
    posts: DataFrame,
    stopwords: Sequence[str],
    lexicon: DataFrame,
    lemmas: DataFrame,
    categories: Sequence[str] | None = CATEGORIES,
) -> DataFrame:
    """Posts of the wanted categories with ``cleaned_body``.

    The cheap filters come first; the text work runs only on rows that stay. Filtering earlier
    than the normalisation gives the same rows, because cleaning never empties a text.
    """
    rows = clean.drop_null_subset(posts, ["title", "label", "body"])
    if categories is not None:
        rows = clean.filter_in_list(rows, "subreddit", categories)
    rows = rows.select("row_id", "subreddit", "title", "body", "label", "unique_id")
    return clean.clean_corpus(rows, stopwords, lexicon, lemmas)


def build_corpus(
    raw: DataFrame, stopwords: Sequence[str], lexicon: DataFrame, lemmas: DataFrame,
    categories: Sequence[str] | None = CATEGORIES,
) -> DataFrame:
    """Raw table to (row_id, subreddit, title, body, label, unique_id, cleaned_body)."""
    return final_corpus(keyed_posts(raw), stopwords, lexicon, lemmas, categories).where(
        F.col("cleaned_body").isNotNull()
    )
