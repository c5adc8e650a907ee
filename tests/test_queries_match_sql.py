"""Every registered query against its SQL twin on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as registered
from oracle import oracle_texts
from tillwatch.catalog import QUERIES as OWN

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in registered.queries().items() if name in OWN}
TEXTS = oracle_texts()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TEXTS)


def test_flagship_has_rows(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    relation = duck.sql(TEXTS[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    want = sorted(repr([v[i] for i in order]) for v in relation.fetchall())
    assert got == want
