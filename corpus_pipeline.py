"""A corpus from documents to token ids: five stages, each on all that the one before has kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import langid, pieces, secrets, tiling
from corpusmill.llm.names import unused
from corpusmill.llm.near_dedup import near_duplicates
from corpusmill.llm.queries import tokenizer_path
from corpusmill.sources.staging import stage


def _columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents; of extra ones, those that no operator's result has taken the name of."""
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c in found.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null ones among them, go. A null lang becomes the predicted one, if any was learned."""
    found = langid.predict(docs, langid.learn(docs))
    known = F.col("lang_pred") != langid.UNKNOWN
    kept = found.where(known | F.col("text").rlike(r"\p{L}"))
    return _columns(kept.withColumn("lang", F.coalesce("lang", F.when(known, F.col("lang_pred")))), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return _columns(near_duplicates(docs, k=5, percent=80).where("first"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _columns(tiling.contamination(docs, benchmark).where(F.size("matches") == 0), docs)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars then follows the new text."""
    found = secrets.find(docs)
    [changed] = unused(found.columns, "changed")
    clean = secrets.redacted(found.withColumn(changed, F.size("secrets") > 0))
    chars = F.when(F.col(changed), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _columns(clean.withColumn("n_chars", chars), docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives its text back."""
    model = pieces.load(tokenizer_path("piece_bpe_32k.model"))
    marked = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = pieces.round_trip(marked, model)
    return found.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("scan_secrets", scan_secrets),
    ("tokenise", tokenise),
]

#: Profiles, signatures and merges cannot be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
