"""Registered queries whose result SQL can express, against it."""

from __future__ import annotations

import duckdb
import pytest

from folioflow.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
