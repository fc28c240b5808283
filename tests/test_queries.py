"""Every registered query against its SQL counterpart."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as catalogue

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
SPARK_TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "DOUBLE": "double",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp_ntz",
    "VARCHAR": "string",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(catalogue.library_queries()) <= set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.library_queries()))
def test_query(spark, connection, name):
    df = catalogue.library_queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    cursor = connection.execute(catalogue.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    types = {column[0]: SPARK_TYPES[str(column[1])] for column in cursor.description}
    assert dict(df.dtypes) == types
    expected = [dict(zip(columns, row)) for row in cursor.fetchall()]
    actual = [row.asDict() for row in df.collect()]
    assert sorted(repr([row[n] for n in names]) for row in actual) == sorted(
        repr([row[n] for n in names]) for row in expected
    )


def test_entry(spark):
    assert catalogue.entry(spark).count() == 2
