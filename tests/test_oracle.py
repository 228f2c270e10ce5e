"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registered
import oracle_queries
from told import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def test_each_query_has_sql():
    assert registered.report_queries().keys() == oracle_queries.oracle_sql().keys()


@pytest.mark.parametrize("name", registered.report_queries())
def test_query_equals_sql(spark, duck, name, tmp_path):
    found = registered.report_queries()[name](spark, SF_SMALL)
    cursor = duck.execute(oracle_queries.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    order = sorted(found.columns)
    assert sorted(names) == order
    want = [repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall()]
    got = [repr(tuple(r[c] for c in order)) for r in found.collect()]
    assert len(want) > 0
    assert sorted(got) == sorted(want)


def test_entry(spark):
    found = registered.entry(spark)
    assert found.count() > 0
    assert "explicit_response_percentage" in found.columns
