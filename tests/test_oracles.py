"""Every registered query against its SQL twin, exactly, at the smallest scale factor."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tallyhouse.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    mine = df.collect()
    if name not in entry.oracle_sql():
        assert mine
        return
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(mine, df.columns) == normal(cur.fetchall(), names)


def test_all_are_handed_to_the_driver():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "month_label"
