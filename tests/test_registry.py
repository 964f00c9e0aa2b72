"""Every registered query against its SQL counterpart on the given tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from registry.oracles import oracles
from registry.queries import registered

TABLES = "region nation customer supplier part orders lineitem"
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        assert not math.isnan(value)
        return f"{value:.6f}"
    assert not isinstance(value, Decimal)
    return str(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(registered()) == set(oracles())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, duck, sf_dir, name):
    df = registered()[name](spark, sf_dir)
    wanted = duck.sql(oracles()[name])
    assert sorted((c, SPARK_TYPES[t]) for c, t in df.dtypes) == sorted(
        zip(wanted.columns, map(str, wanted.types), strict=True)
    )
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(wanted.columns, wanted.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() == 7
