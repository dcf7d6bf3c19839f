"""The operators whose results SQL expresses, against DuckDB on whole tables."""

from __future__ import annotations

import glob
import os

import pytest

from seatledger.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    rows = lambda found: sorted(tuple(str(r[n]) for n in sorted(names)) for r in found)
    assert rows(r.asDict() for r in got.collect()) == rows(dict(zip(names, r, strict=True)) for r in res.fetchall())
