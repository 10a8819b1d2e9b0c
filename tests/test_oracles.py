"""Every registered core query against its SQL on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from siltworks.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 6) if isinstance(value, float) else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
