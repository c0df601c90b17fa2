"""Registered queries over the shared test tables, each beside the SQL that checks it."""

from corpusmill.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
