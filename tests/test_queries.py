"""Every registered query against its SQL, on the smallest given tables."""

import datetime as dt
import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def normal(rows):
    return sorted((tuple(map(plain, row)) for row in rows), key=repr)


# the training-data queries are tested beside their operators
OWN = [name for name in registry.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_sql():
    assert set(OWN) <= registry.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    result = result.select(*columns)
    expected = duck.sql(f"select {', '.join(columns)} from ({registry.oracle_sql()[name]})")
    assert columns == sorted(duck.sql(registry.oracle_sql()[name]).columns)
    assert [TYPES[field.dataType.simpleString()] for field in result.schema] == list(map(str, expected.types))
    rows = normal(result.collect())
    assert rows == normal(expected.fetchall())
    assert rows


def test_entry(spark):
    assert registry.entry(spark).count() > 0
