"""Every query of the snapshot engine against its SQL."""

import os

import duckdb
import pytest

from tickloom.plans import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(rows, names):
    show = lambda x: None if x is None or x != x else repr(float(x)) if isinstance(x, float) else str(x)
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(show(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, DATA)
    rows = [tuple(r) for r in got.collect()]
    assert rows
    if sql := queries.oracle_sql().get(name):
        con = duckdb.connect()
        con.sql(f"create view events as select * from '{DATA}/events.parquet'")
        want = con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(rows, got.columns) == plain(want.fetchall(), want.columns)
