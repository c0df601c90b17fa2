"""Arrays to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_values(df: DataFrame, keep: Sequence[str | Column], values: Column | str, name: str) -> DataFrame:
    """One row per array element, none for an empty or missing array.

    A plain explode makes the optimizer test the size of the array in a filter below, which
    computes the array expression once more per test. The outer form, with a filter on the
    element above it, computes it once.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def posexplode_values(
    df: DataFrame, keep: Sequence[str | Column], values: Column | str, position: str, name: str
) -> DataFrame:
    """The same with the 0-based position of the element."""
    return df.select(*keep, F.posexplode_outer(values).alias(position, name)).where(F.col(name).isNotNull())
