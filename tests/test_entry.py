"""The registered jobs against their SQL on the smallest tables."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from volspark.plans.oracles import ORACLES
from volspark.plans.queries import QUERIES

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return str(v.date()) if isinstance(v, dt.datetime) else repr(v)

    return sorted([plain(row[i]) for i in order] for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(driver.queries())


@pytest.mark.skipif(not TABLES.exists(), reason="tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = driver.queries()[name](spark, str(TABLES))
    want = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, map(tuple, got.collect())) == rows_of(columns, want.fetchall())


@pytest.mark.skipif(not TABLES.exists(), reason="tables are not here")
def test_entry(spark):
    assert driver.entry(spark).where("status = 'ok'").count() > 5000
