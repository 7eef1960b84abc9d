"""Queries that SQL can express, side by side with DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from eventmart.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"create view {table} as select * from read_parquet('{SF_ORACLE}/{table}.parquet')")
    rel = con.sql(ORACLES[name])
    order = sorted(rel.columns)
    want = sorted(repr(tuple(dict(zip(rel.columns, r, strict=True))[c] for c in order)) for r in rel.fetchall())
    got = QUERIES[name](spark, SF_ORACLE)
    assert sorted(got.columns) == order
    assert sorted(repr(tuple(r[c] for c in order)) for r in got.collect()) == want
