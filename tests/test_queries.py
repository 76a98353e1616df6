"""Every registered query against its SQL text, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from jobloom.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the standard tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    found = driver.queries()[name](spark, DATA)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    if name in driver.oracle_sql():
        result = duck.execute(driver.oracle_sql()[name])
        assert table(found.columns, rows) == table([c[0] for c in result.description], result.fetchall())


def test_every_query_has_a_text():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
