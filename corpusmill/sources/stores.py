"""Parquet stores for vectors and item sets, and ML model folders."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR_SCHEMA = "unique_id LONG, label INT, embedding ARRAY<FLOAT>"
ITEMSET_SCHEMA = "unique_id LONG, label INT, items ARRAY<STRING>"


def _to_schema(df: DataFrame, ddl: str) -> DataFrame:
    schema = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def save_vectors(df: DataFrame, path: str) -> None:
    """Vectors with key and label in the same row, so nothing is aligned by position later."""
    _to_schema(df, VECTOR_SCHEMA).write.parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTOR_SCHEMA).parquet(path)


def save_itemsets(df: DataFrame, path: str) -> None:
    """Item sets as arrays."""
    _to_schema(df, ITEMSET_SCHEMA).write.parquet(path)


def load_itemsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEMSET_SCHEMA).parquet(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(model_class: type, path: str):
    return model_class.load(path)
