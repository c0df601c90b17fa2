"""Delimited text: CSV and TSV, plain or gzip, with or without a header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.records import parse_records, read_records

# Strings that count as missing when a text table is read.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A doubled quote inside quotes, and values kept exactly as they are.
_DIALECT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def missing_to_null(df: DataFrame, na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """Listed strings, and NaN in floating-point columns, become NULL."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and na_values:
            c = F.when(~c.isin(list(na_values)), c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(field.name))
    return df.select(*out)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    na_values: Sequence[str] = NA_VALUES,
    partitions: int | None = None,
    multi_line: bool = True,
    ranges: bool = False,
) -> DataFrame:
    """Read delimited text with an explicit schema, and its column names by position.

    A header that names other columns, or the same in another order, fails the job. With ``multi_line`` quoted values may hold
    line breaks, and one file is one task, as is a gzip file; without it, as for texts whose white space was collapsed, large
    files are split. With ``ranges`` values may hold line breaks and large files are split all the same, for a second scan (see
    ``records``); lines then end with a line feed. ``partitions`` spreads the rows of few large files right after the scan.
    """
    if ranges:
        df = parse_records(read_records(spark, path, sep), schema, sep, header, _DIALECT)
    else:
        df = spark.read.schema(schema).csv(path, sep=sep, header=header, multiLine=multi_line, mode="FAILFAST",
                                           enforceSchema=not header, **_DIALECT)
    df = missing_to_null(df, na_values)
    return df.repartition(partitions) if partitions else df


def write_delimited(
    df: DataFrame, path: str, sep: str = "\t", header: bool = True, gzip: bool = False
) -> None:
    """Write delimited text without an index column; NULL is the empty field."""
    df.write.csv(path, sep=sep, header=header, compression="gzip" if gzip else "none", **_DIALECT)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Comma-separated table with a header line."""
    return read_delimited(spark, path, schema, sep=",", header=True, **options)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Tab-separated table with a header line; gzip is recognised by the file name."""
    return read_delimited(spark, path, schema, sep="\t", header=True, **options)


def read_tsv_headerless(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Tab-separated table without a header line."""
    return read_delimited(spark, path, schema, sep="\t", header=False, **options)
