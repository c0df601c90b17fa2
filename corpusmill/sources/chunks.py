"""Contiguous chunks of a keyed table, and their merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_chunk(df: DataFrame, key: str = "unique_id", parts: int = 100) -> DataFrame:
    """Chunk number of each row: ``ceil(n / parts)`` consecutive keys 0..n-1 per chunk."""
    n = df.count()
    rows_per_chunk = max(1, -(-n // parts))
    return df.withColumn("chunk", F.floor(F.col(key) / F.lit(rows_per_chunk)).cast("int"))


def partition_split(df: DataFrame, path: str, key: str = "unique_id", parts: int = 100) -> None:
    """Write one folder per chunk. Range partitioning lets a large chunk span several tasks."""
    chunked = with_chunk(df, key, parts)
    chunked.repartitionByRange("chunk", key).write.partitionBy("chunk").parquet(path)


def partition_merge(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All chunks as one table; ``chunk`` is an integer, so its order is numeric.

    A missing folder fails the read; the order of rows is left to the export.
    """
    fields = [f for f in schema.fields if f.name != "chunk"]
    return spark.read.schema(T.StructType([*fields, T.StructField("chunk", T.IntegerType())])).parquet(path)


def order_by_chunk(files: DataFrame, name: str = "name") -> DataFrame:
    """File names in the numeric order of the number after the first underscore."""
    number = F.regexp_extract(F.col(name), r"_(\d+)", 1).try_cast("int")
    return files.withColumn("chunk", number).orderBy("chunk", name)
