"""Every registered query against its SQL counterpart in DuckDB."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def shown(value):
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([shown(row[c]) for c in columns] for row in df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted([shown(row[i]) for i in places] for row in cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
