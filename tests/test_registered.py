"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from helpers import rows
from ledgerloom.testbed.queries import registered

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
KINDS = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def kind(data_type):
    return KINDS.get(data_type.simpleString(), data_type.simpleString())


def test_every_query_of_the_library_has_sql():
    assert set(registered()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    expected = duck.sql(entry.oracle_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {field.name: kind(field.dataType) for field in got.schema} == types
    key = lambda row: [(value is not None, str(value)) for value in row]
    wanted = sorted(expected.select(*[duckdb.ColumnExpression(column) for column in columns]).fetchall(), key=key)
    assert wanted, "an empty result proves nothing"
    assert rows(got, *columns) == wanted


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["order_date", "channel"] and result.count() > 0
