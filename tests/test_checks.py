"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import PIPELINE, entry, llm_queries, oracle_sql, queries
from check import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


OWN = sorted(set(queries()) - set(llm_queries()) - set(PIPELINE))


def test_every_query_has_a_check():
    assert set(OWN) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, con, sf, name):
    same, rows, _, _, diff = compare(spark, con, sf, name)
    assert same, diff
    assert rows > 0


def test_entry(spark):
    out = entry(spark)
    assert out.columns == ["generation_id", "scenario"]
    assert out.limit(1).count() == 1
