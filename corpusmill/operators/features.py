"""Feature families: itemset indicators, TF-IDF, word vectors, supplied encoders, components."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
)
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as tx
from corpusmill.operators.aggregates import vector_mean
from corpusmill.operators.components import Components, fit_components
from corpusmill.operators.itemsets import triplet_matches, triplet_name
from corpusmill.operators.parts import parts_for
from corpusmill.operators.rows import explode_values
from corpusmill.operators.ranks import text_rank
from corpusmill.operators.wordvectors import WordVectors, fit_word_vectors
from corpusmill.sources.staging import stage

# Vector forms keep their vocabulary on the driver and in each task, so they have a limit; the long forms have none.
MAX_VOCABULARY = 1_000_000
# Parts that the rows of one term are dealt to when terms are joined.
TERM_PARTS = 8
# Words that one task of a word-vector fit trains on: of a small corpus, and of any.
WORDS_PER_PART = 200_000
MOST_WORDS_PER_PART = 3_500_000


# --- itemset indicators ----------------------------------------------------------------------


def triplet_index(triplets: DataFrame) -> DataFrame:
    """(a, b, c, triplet, idx): position of each frequent triplet in name order, counted in two phases."""
    named = triplets.select("a", "b", "c", triplet_name().alias("triplet"))
    return text_rank(named, "triplet", "idx").withColumn("idx", (F.col("idx") - 1).cast("int"))


def triplet_multihot(baskets: DataFrame, triplets: DataFrame, key: str = "unique_id") -> DataFrame:
    """Long form of the 0/1 matrix, ones only: (key, idx)."""
    found = triplet_matches(baskets.select(key, "items"), triplets)
    return found.join(stage(triplet_index(triplets), "triplet-index"), ["a", "b", "c"]).select(key, "idx")


def _vocabulary(terms: DataFrame, column: str, most: int = MAX_VOCABULARY) -> list[str]:
    rows = terms.select(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} terms; use the long form")
    return sorted(r[column] for r in rows)


def _count_vectors(df: DataFrame, terms: str, vocabulary: Sequence[str], out: str, binary: bool = False) -> DataFrame:
    if not vocabulary:
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    spark_model = CountVectorizerModel.from_vocabulary(
        list(vocabulary), inputCol=terms, outputCol=out, minTF=0.0, binary=binary
    )
    return spark_model.transform(df)


def triplet_vectors(
    baskets: DataFrame, triplets: DataFrame, key: str = "unique_id", out: str = "features"
) -> DataFrame:
    """The baskets with a sparse 0/1 vector over all frequent triplets; no match gives zeros."""
    found = triplet_matches(baskets.select(key, "items"), triplets).select(key, triplet_name().alias("t"))
    names = found.groupBy(key).agg(F.collect_list("t").alias("_terms"))
    joined = baskets.drop("items").join(names, key, "left")
    joined = joined.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>")))
    vocabulary = _vocabulary(triplets.select(triplet_name().alias("t")), "t")
    return _count_vectors(joined, "_terms", vocabulary, out, binary=True).drop("_terms")


# --- TF-IDF ----------------------------------------------------------------------------------


def document_frequencies(
    df: DataFrame, tokens: str, min_df: float = 0.01, max_n: int = 3
) -> tuple[DataFrame, int]:
    """(term, df) of all n-grams with df >= min_df * n, and n.

    Level by level: a longer n-gram can only be frequent if both of its shorter parts are, so most
    n-grams are dropped where they are read and never reach a shuffle. The result is exact. The
    tokens are read once per level, so give it a stage table.
    """
    n = df.count()
    least = min_df * n
    level = None
    levels = []
    for size in range(1, max_n + 1):
        terms = explode_values(df, [], F.array_distinct(tx.ngrams(tokens, size)), "term")
        if level is not None:
            # The level is a stage table, so Spark knows whether it is small enough to broadcast.
            shorter = level.select(F.col("term").alias("_part"))
            for side in (size - 1, -(size - 1)):
                part = F.substring_index("term", " ", side)
                terms = terms.join(shorter, part == F.col("_part"), "left_semi")
        counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        level = stage(counts.where(F.col("df") >= F.lit(least)), f"terms-{size}")
        levels.append(level)
    vocabulary = levels[0]
    for extra in levels[1:]:
        vocabulary = vocabulary.unionByName(extra)
    return vocabulary, n


def _weights(idf, max_n: int) -> Callable:
    """Rows (key, term, weight) of Arrow batches (key, tokens), from a broadcast dictionary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = idf.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                rows, terms, weights = [], [], []
                for i, words in enumerate(batch.column(1).to_pylist()):
                    words = words or []
                    counts = Counter(w for w in words if w in known)
                    for n in range(2, max_n + 1):
                        counts.update(t for t in map(" ".join, zip(*[words[j:] for j in range(n)])) if t in known)
                    raw = {t: c * known[t] for t, c in counts.items()}
                    norm = math.sqrt(sum(x * x for x in raw.values()))
                    rows += [i] * len(raw)
                    terms += raw
                    weights += [x / norm for x in raw.values()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.string()), pa.array(weights, pa.float64())],
                    names=[batch.schema.names[0], "term", "weight"],
                )

    return work


@dataclass(frozen=True)
class TfidfModel:
    """Vocabulary with document frequencies of the training texts."""

    vocabulary: DataFrame  # (term, df), stage tables
    n_texts: int
    max_n: int = 3

    def idf(self) -> Column:
        """ln((1 + n) / (1 + df)) + 1."""
        return F.log((1.0 + F.lit(self.n_texts)) / (1.0 + F.col("df"))) + 1.0

    def transform_long(
        self, df: DataFrame, tokens: str = "tokens", key: str = "unique_id", most: int = MAX_VOCABULARY
    ) -> DataFrame:
        """(key, term, weight): tf * idf with unit length per text; unknown terms are dropped.

        Terms are counted in the row. A vocabulary of up to ``most`` terms is looked up there too, so no row is shuffled; a larger
        one is joined by term, each term's rows dealt to parts. Both give the same rows.
        """
        found = self.vocabulary.select("term", self.idf().alias("idf")).limit(most + 1).toArrow()
        if found.num_rows <= most:
            idf = dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))
            sent = df.sparkSession.sparkContext.broadcast(idf)
            kind = df.schema[key].dataType.simpleString()
            rows = df.select(key, tokens)
            return rows.mapInArrow(_weights(sent, self.max_n), f"`{key}` {kind}, term string, weight double")
        terms = explode_values(df, [key], tx.ngrams_up_to(tokens, self.max_n), "term")
        part = F.pmod(F.xxhash64(key), F.lit(TERM_PARTS)).alias("_part")
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(TERM_PARTS - 1).cast("long"))).alias("_part")
        counted = terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("_n"))
        weights = self.vocabulary.select("term", self.idf().alias("_idf"), parts)
        raw = counted.select("*", part).join(weights, ["term", "_part"]).select(key, "term", (F.col("_n") * F.col("_idf")).alias("_raw"))
        norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
        return raw.select(key, "term", (F.col("_raw") / norm).alias("weight"))

    def transform(
        self, df: DataFrame, tokens: str = "tokens", out: str = "features", most: int = MAX_VOCABULARY
    ) -> DataFrame:
        """Sparse vectors of the same weights, in term order; row by row, without a shuffle."""
        rows = self.vocabulary.select("term", self.idf().alias("idf")).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} terms; use transform_long")
        idf = {r["term"]: r["idf"] for r in rows}
        terms = sorted(idf)
        counted = _count_vectors(
            df.withColumn("_terms", tx.ngrams_up_to(tokens, self.max_n)), "_terms", terms, "_tf"
        )
        scaled = ElementwiseProduct(
            scalingVec=Vectors.dense([idf[t] for t in terms]), inputCol="_tf", outputCol="_raw"
        ).transform(counted)
        return Normalizer(p=2.0, inputCol="_raw", outputCol=out).transform(scaled).drop("_terms", "_tf", "_raw")


def tfidf_fit(df: DataFrame, tokens: str = "tokens", min_df: float = 0.01, max_n: int = 3) -> TfidfModel:
    vocabulary, n = document_frequencies(df, tokens, min_df, max_n)
    return TfidfModel(vocabulary, n, max_n)


def tfidf_fit_transform(df: DataFrame, tokens: str = "tokens", **options) -> DataFrame:
    """Vectors of the texts that the model is fitted on."""
    return tfidf_fit(df, tokens, **options).transform(df, tokens)


# --- word vectors ----------------------------------------------------------------------------


def word2vec_fit(
    df: DataFrame, tokens: str = "tokens", size: int = 100, window: int = 5, min_count: int = 2,
    partitions: int | None = None, iterations: int = 1, seed: int = 42,
) -> WordVectors:
    """Word vectors from token arrays. ``partitions`` trains on that many parts at once; by default eight, of
    ``WORDS_PER_PART`` words at least and ``MOST_WORDS_PER_PART`` at most, so the work of a task does not grow with the
    corpus. The parts are averaged after each of the ``iterations``. Parts hold the vectors of their own words; the driver
    holds none."""
    parts = partitions or parts_for(df, tokens, WORDS_PER_PART, MOST_WORDS_PER_PART)
    return fit_word_vectors(df, tokens, size, window, min_count, parts, iterations, seed)


def word_vectors(model: WordVectors) -> DataFrame:
    """(word, vector ARRAY<DOUBLE>)."""
    return model.getVectors()


def sentence_embedding(df: DataFrame, model: WordVectors, tokens: str = "tokens", key: str = "unique_id") -> DataFrame:
    """Mean of the known word vectors per text. Unlike ``model.transform``, unknown words do not
    count in the divisor."""
    return vector_mean(df, tokens, model.vectors, model.getVectorSize(), key)


# --- supplied encoders -----------------------------------------------------------------------


def batch_embed(
    df: DataFrame, text: str, make_encoder: Callable[[], Callable], batch_size: int = 64,
    key: str = "unique_id", out: str = "embedding",
) -> DataFrame:
    """(key, out ARRAY<FLOAT>) from an encoder that the caller supplies.

    ``make_encoder`` runs once per Python worker and returns a function from a batch of texts to
    an array with one vector per row. How long texts are read is up to the encoder.
    """
    encode = predict_batch_udf(make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return df.select(key, encode(text).alias(out))


def vector_unwrap(df: DataFrame, vector: str = "embedding", size: int | None = None, out: str = "features") -> DataFrame:
    """Array column to an ML vector; a row of the wrong length fails the job."""
    values = F.col(vector).cast("array<double>")
    if size is not None:
        failure = F.raise_error(F.concat(F.lit("vector of size "), F.size(vector).cast("string")))
        values = F.when(F.size(vector) == size, values).otherwise(failure)
    return df.withColumn(out, array_to_vector(values))


# --- components ------------------------------------------------------------------------------


def pca_2d(df: DataFrame, features: str = "features", model: Components | None = None) -> DataFrame:
    """First two principal components of the centred data, as ``pc1`` and ``pc2``; null for a null vector.

    The sign is fixed so that the largest loading of each component is positive. ``model`` holds components fitted before.
    """
    found = (model or fit_components(df, 2, features)).transform(df, features, "_pc")
    return found.withColumns({"pc1": F.col("_pc")[0], "pc2": F.col("_pc")[1]}).drop("_pc")
