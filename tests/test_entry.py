"""The registered queries of the base engine against DuckDB on the smallest tables."""

from __future__ import annotations

import glob
import os

import pytest

from tessera.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS FROM '{p}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    want = duck.sql(ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    rows = lambda t: sorted(map(repr, zip(*[t[c].to_pylist() for c in columns], strict=True)))
    assert rows(got) == rows(want)
    assert [str(got.schema.field(c).type) for c in columns] == [str(want.schema.field(c).type) for c in columns]


def test_entry_imports():
    import __spark_entry__ as e

    assert QUERIES.keys() <= e.queries().keys()
    assert ORACLE_SQL.keys() <= e.oracle_sql().keys()
