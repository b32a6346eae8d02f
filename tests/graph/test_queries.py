"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from graphloom import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'").fetchall()
    return connection


def plain(rows):
    return sorted((tuple(map(str, r)) for r in rows))


@pytest.mark.parametrize("name", Q.QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    got = Q.QUERIES[name](spark, SF)
    told = tables.execute(Q.ORACLES[name])
    columns = [c[0] for c in told.description]
    assert sorted(columns) == sorted(got.columns)
    assert plain(got.select(columns).collect()) == plain(told.fetchall())


def test_entry_builds_without_a_collect(spark):
    assert Q.entry(spark, SF).columns == ["speaker", "group"]
