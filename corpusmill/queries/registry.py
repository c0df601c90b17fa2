"""One entry per operator: a Spark query and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from corpusmill.functions.stopwords import ENGLISH

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("sources", "tables", "text", "mining", "sampling", "models", "metrics")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        import_module(f"corpusmill.queries.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
    return {name: sql.replace("@STOPWORDS@", words) for name, sql in _SQL.items()}
