"""Driver contract: entry(), queries(), oracle_sql() - and Spark vs DuckDB on sf0.001."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from folioflow.plans import landed_queries, queries as _core, write_queries  # noqa: F401, E402
from folioflow.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (2, str(v))
    return (5, str(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["acao", "qtd_codigo", "participacao", "qtd_teorica_total", "data"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE_SQL) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())
    rel = duck.sql(entry_mod.oracle_sql()[name])
    names = rel.columns
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want
