"""Nested schemas compared path by path."""

from __future__ import annotations

import pytest

from loadwarden.operators import RESULT_SCHEMA, nested_conformance, schema_differences

ACTUAL = "id bigint, s struct<a: int, B: string, deep: struct<x: array<map<string, int>>>>, l array<struct<v: double>>, more date"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([], ACTUAL)


def found(table, expected, **options):
    return [tuple(r) for r in schema_differences(table, expected, **options).collect()]


def test_equal_schemas_in_any_order(table):
    assert found(table, ACTUAL) == []
    assert found(table, "more date, l array<struct<v: double>>, s struct<B: string, deep: struct<x: array<map<string, int>>>, a: int>, id bigint") == []


def test_a_row_for_each_path_in_a_fixed_order(table):
    expected = "l array<struct<v: float, w: int>>, id int, s struct<a: int, b: string, deep: struct<x: array<map<int, string>>>>"
    assert found(table, expected) == [
        ("l[].v", "type", "float", "double"),
        ("l[].w", "missing", "int", None),
        ("id", "type", "int", "bigint"),
        ("s.b", "missing", "string", None),
        ("s.deep.x[]{key}", "type", "int", "string"),
        ("s.deep.x[]{value}", "type", "string", "int"),
        ("s.B", "extra", None, "string"),
        ("more", "extra", None, "date"),
    ]


def test_a_struct_instead_of_a_plain_type(table):
    assert found(table, ACTUAL.replace("l array<struct<v: double>>", "l string")) == [
        ("l", "type", "string", "array<struct<v:double>>")
    ]


def test_nulls_where_none_are_expected(spark):
    table = spark.sql("select 1 as a, named_struct('x', cast(null as int)) as s, array(1, null) as l")
    expected = "a int not null, s struct<x: int not null>, l array<int>"
    assert found(table, expected) == []
    assert found(table, expected, nullability=True) == [("s.x", "nullable", "int", "int")]
    assert found(spark.sql("select 1 as a"), "a int", nullability=True) == []


def test_odd_names(spark):
    table = spark.createDataFrame([], "`a.b` struct<`c d`: int>, `e``f` int")
    assert found(table, "`a.b` struct<`c d`: string>") == [
        ("`a.b`.`c d`", "type", "string", "int"),
        ("`e``f`", "extra", None, "int"),
    ]


def test_check_rows(table):
    checks = nested_conformance(table, "id bigint, s struct<a: string, B: string>, gone int, l array<struct<v: double>>", "t")
    assert checks.schema == RESULT_SCHEMA or [c.name for c in checks.schema] == RESULT_SCHEMA.names
    assert [(r.test_name, r.status, r.reason) for r in checks.collect()] == [
        ("id data_type", "PASS", "Expected Datatype"),
        ("s.a data_type", "FAIL", "Expected string, but got int"),
        ("s.deep data_type", "FAIL", "Expected nothing, but got struct<x:array<map<string,int>>>"),
        ("gone data_type", "FAIL", "Expected int, but it is missing"),
        ("l data_type", "PASS", "Expected Datatype"),
        ("more data_type", "FAIL", "Expected nothing, but got date"),
    ]
