"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from checks.registry import names

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return con


def rows(table, names):
    picked = [names.index(n) for n in sorted(names)]
    return sorted((tuple(row[i] for i in picked) for row in table), key=repr)


def test_every_query_has_sql():
    assert set(names()) <= set(driver.queries())
    assert set(names()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", names())
def test_same_rows(spark, oracle, name):
    df = driver.queries()[name](spark, SF)
    got = df.collect()
    want = oracle.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in got], df.columns) == rows(want.fetchall(), want.columns)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
