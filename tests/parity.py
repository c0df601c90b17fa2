"""Compare registered queries with their SQL. Run as a script: parity.py SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(plain, key=lambda r: [(x is not None, type(x).__name__, x) for x in r])


def difference(spark, con, sf_dir, fn, sql) -> str | None:
    """Why a query differs from its SQL, or None."""
    got = fn(spark, sf_dir)
    names, rows = sorted_rows(got.columns, got.collect())
    if sql is None:
        return None if rows else "no rows"
    want = con.execute(sql)
    want_names, want_rows = sorted_rows([c[0] for c in want.description], want.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows, expected {len(want_rows)}"
    for a, b in zip(rows, want_rows):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return None if rows else "no rows on either side"


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from corpusmill.session import get_session

    spark = get_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, fn, sql.get(name))
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.1f}s {'ok ' if problem is None else 'BAD'} {'sql' if name in sql else '   '} {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(names or queries())} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
