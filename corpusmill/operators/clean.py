"""Filters, casts, projections and text normalisation of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.sources.staging import stage

# Lemma classes from the first that counts to the last.
CLASS_ORDER = ("n", "v", "a", "r")
# Text of a dictionary that is sent to every task.
DICTIONARY_BYTES = 16 << 20
# Texts whose tokens a task looks up at once.
TEXTS_AT_ONCE = 500
# Parts that the rows of one word are dealt to when words are joined.
WORD_PARTS = 8


def drop_null_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is missing."""
    return df.na.drop(subset=list(columns))


def drop_all_null(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop rows where every column outside ``ignore`` is missing."""
    return df.na.drop(how="all", subset=[c for c in df.columns if c not in ignore])


def filter_nonblank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither missing nor blank."""
    return df.where(tx.is_nonblank(column))


def fill_null(df: DataFrame, column: str, value) -> DataFrame:
    """Missing values of one column become ``value``."""
    return df.na.fill({column: value})


def to_nullable_int(c: Column | str) -> Column:
    """Number to BIGINT; a fractional value is an error, NULL stays NULL."""
    value = F.col(c) if isinstance(c, str) else c
    failure = F.raise_error(F.concat(F.lit("not an integral value: "), value.cast("string")))
    return F.when(value.isNull() | (value == F.floor(value)), value.cast("bigint")).otherwise(failure)


def cast_nullable_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_nullable_int(c) for c in columns})


def coerce_numeric(df: DataFrame, column: str, to: str = "double") -> DataFrame:
    """Text to number; unreadable text becomes NULL."""
    return df.withColumn(column, F.col(column).try_cast(to))


def epoch_to_timestamp(df: DataFrame, column: str = "created_utc", out: str = "created_datetime") -> DataFrame:
    """Seconds since 1970 to a timestamp; the source column is dropped."""
    return df.withColumn(out, F.timestamp_seconds(F.col(column))).drop(column)


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def filter_in_list(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(allowed)))


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def lemma_table(lexicon: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(token, lemma) from lexicon(token, tag) and lemmas(token, class, lemma): one lemma per token.

    A token without a tag counts as a noun. Of several classes the first in the order noun, verb, adjective, adverb counts, of
    several lemmas the smallest. Only tokens that change are kept.
    """
    tagged = lexicon.select("token", tx.lexical_class("tag").alias("class"))
    listed = lemmas.join(tagged, ["token", "class"], "left_semi")
    untagged = lemmas.where(F.col("class") == "n").join(tagged, "token", "left_anti")
    place = F.array_position(F.array(*[F.lit(c) for c in CLASS_ORDER]), F.col("class"))
    first = F.struct(F.when(place > 0, place).otherwise(len(CLASS_ORDER) + 1), F.col("lemma"))
    both = listed.unionByName(untagged).groupBy("token").agg(F.min_by("lemma", first).alias("lemma"))
    return both.where("token <> lemma")


def _replace(table) -> Callable:
    """Arrow batches of token arrays with each token's lemma, from a broadcast dictionary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lemma = table.value.get
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                lists = batch.column(batch.num_columns - 1)
                coded = lists.flatten().dictionary_encode()  # each different word is looked up once
                words = pa.array([lemma(w, w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
                ends = pa.array([0, *np.cumsum(lists.value_lengths().fill_null(0).to_numpy()).tolist()], pa.int32())
                new = pa.ListArray.from_arrays(ends, words, mask=lists.is_null())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], new], names=batch.schema.names)

    return work


def _joined_lemmas(df: DataFrame, tokens: str, table: DataFrame, key: str) -> DataFrame:
    """The same by a join of the distinct words of each text, for a dictionary that is too large for a task.

    A word that many texts have is dealt to parts, and its lemma to each part.
    """
    part = F.pmod(F.xxhash64(key), F.lit(WORD_PARTS)).alias("_part")
    words = df.select(key, part, F.explode(F.array_distinct(tokens)).alias("token"))
    parts = table.select("token", "lemma", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(WORD_PARTS - 1).cast("long"))).alias("_part"))
    found = words.join(parts, ["token", "_part"]).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas")
    )
    looked_up = df.join(found, key, "left")
    new = F.transform(tokens, lambda t: F.coalesce(F.try_element_at("_lemmas", t), t))
    return looked_up.withColumn(tokens, new).select(*df.columns)


def lemma_lookup(
    df: DataFrame, tokens: str, lexicon: DataFrame, lemmas: DataFrame, key: str = "unique_id",
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Replace each token by its lemma; unknown tokens and the word order stay.

    A dictionary of up to ``dictionary_bytes`` of text is sent to the tasks and the rows stay where they are. A larger one is
    joined by word. Both give the same rows.
    """
    table = stage(lemma_table(lexicon, lemmas), "lemmas")
    size = table.agg(F.sum(F.octet_length("token") + F.octet_length("lemma"))).first()[0] or 0
    if size > dictionary_bytes:
        return _joined_lemmas(df, tokens, table, key)
    words = dict(zip(*[c.to_pylist() for c in table.select("token", "lemma").toArrow().columns], strict=True))
    last = df.select(*[c for c in df.columns if c != tokens], F.col(tokens).cast("array<string>").alias(tokens))
    sent = df.sparkSession.sparkContext.broadcast(words)
    return last.mapInArrow(_replace(sent), last.schema).select(*df.columns)


def normalize_or_original(normalized: Column, original: Column) -> Column:
    """The normalised text, or the original where nothing is left; NULL stays NULL."""
    return F.when(original.isNotNull(), F.when(tx.is_nonblank(normalized), normalized).otherwise(original))


def clean_corpus(
    df: DataFrame,
    stopwords: Sequence[str],
    lexicon: DataFrame,
    lemmas: DataFrame,
    text: str = "body",
    key: str = "unique_id",
    out: str = "cleaned_body",
) -> DataFrame:
    """Normalise, drop stop words, lemmatise, and fall back to the original text."""
    words = tx.remove_stopwords(tx.tokenize(text), stopwords)
    looked_up = lemma_lookup(df.withColumn("_tokens", words), "_tokens", lexicon, lemmas, key)
    joined = F.array_join("_tokens", " ")
    return looked_up.select(*df.columns, normalize_or_original(joined, F.col(text)).alias(out))
