"""Profiles of a table: counts, nulls, distinct values. One scan each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import is_nonblank


def _per_column(df: DataFrame, columns: Sequence[str] | None, measure, out: str) -> DataFrame:
    """One aggregate per column, turned into one row per column."""
    names = list(columns or df.columns)
    one_row = df.agg(*[measure(n).alias(n) for n in names])
    return one_row.unpivot([], names, "column_name", out)


def profile_nonnull(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, dtype, n_nonnull)."""
    counts = _per_column(df, columns, F.count, "n_nonnull")
    types = F.create_map(*[F.lit(x) for name, t in df.dtypes for x in (name, t)])
    return counts.select("column_name", types[F.col("column_name")].alias("dtype"), "n_nonnull")


def profile_distinct(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """(column_name, n_distinct); missing counts as one value.

    Values are compared by their SHA-256 digest, so long texts are not shuffled. Each value is one narrow row (column,
    digest), and repeats collapse in each task before the shuffle; the wide rows are never copied.
    """
    names = list(columns or df.columns)
    if approximate:
        def measure(name: str) -> Column:
            return F.approx_count_distinct(F.col(name)) + F.coalesce(F.max(F.col(name).isNull().cast("long")), F.lit(0))

        return _per_column(df, names, measure, "n_distinct")
    digests = [F.unhex(F.sha2(F.col(c).cast("string"), 256)).alias(c) for c in names]
    values = df.select(*digests).unpivot([], names, "column_name", "value").distinct()
    counted = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column_name string")
    return every.join(counted, "column_name", "left").na.fill(0)


def profile_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of each column as text: (column_name, value)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return long.unpivot([], list(columns), "column_name", "value").distinct()


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null)."""
    return _per_column(df, columns, lambda n: F.count_if(F.col(n).isNull()), "n_null")


def rows_with_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of rows with at least one missing value."""
    any_null = F.lit(False)
    for n in columns or df.columns:
        any_null = any_null | F.col(n).isNull()
    return df.agg(F.count_if(any_null).alias("n_rows"))


def exists_value(df: DataFrame, column: str, value) -> DataFrame:
    """One row: does any row hold ``value``; a missing value is no match."""
    return df.agg(F.coalesce(F.bool_or(F.col(column) == F.lit(value)), F.lit(False)).alias("found"))


def row_count(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def head_n(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def count_pattern(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """One row: total matches of each named pattern over a text column."""
    return df.agg(*[
        F.coalesce(F.sum(F.regexp_count(F.col(column), F.lit(p)).cast("long")), F.lit(0)).alias(name)
        for name, p in patterns.items()
    ])


def count_nonblank(df: DataFrame, column: str) -> DataFrame:
    """One row: number of rows whose text is not blank."""
    return df.agg(F.count_if(is_nonblank(column)).alias("n_nonblank"))
