"""Every registered query with SQL, and every case of a landed document, against DuckDB on the smallest tables."""

from __future__ import annotations

import glob
import os

import pytest

from seatledger.plans import queries, table_queries  # noqa: F401  both register
from tests import document_cases as document_queries

QUERIES = queries.QUERIES | document_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | document_queries.ORACLE_SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _cell(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def test_names_are_distinct():
    assert not queries.QUERIES.keys() & document_queries.QUERIES.keys()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    res = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted([_cell(dict(zip(names, r, strict=True))[c]) for c in cols] for r in res.fetchall())
    assert sorted([_cell(r[c]) for c in cols] for r in got.collect()) == want
