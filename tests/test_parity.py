"""Every registered query against its SQL, and the registry itself."""

from __future__ import annotations

from pathlib import Path

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from parity import connect, difference

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_sql_keys_are_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) is None


@needs_data
def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert rows[0]["difference"] == rows[0]["cnt_1"] - rows[0]["cnt_0"]
