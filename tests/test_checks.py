from __future__ import annotations

import datetime as dt

import pytest

from loadwarden.operators import (
    RESULT_SCHEMA,
    column_count_check,
    combine_results,
    primary_key_check,
    quality_checks,
    row_count_drift,
    row_count_floor,
    schema_conformance,
)

ABOVE = "Count increase percentage ({}%) is more than threshold ({}%)"
BELOW = "Count increase percentage  is below threshold ({}%)"


def outcome(df):
    return [(r["test_name"], r["status"], r["reason"]) for r in df.collect()]


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 2)], "personID int, name string, Wins int")


def test_schema_conformance(table):
    expected = [
        ("personID", "bigint"),
        ("name", "string"),
        ("gone", "int"),
        ("wins", "int"),
        ("Wins", "int"),
    ]
    assert outcome(schema_conformance(table, expected, "t")) == [
        ("personID data_type", "FAIL", "Expected bigint, but got int"),
        ("name data_type", "PASS", "Expected Datatype"),
        ("gone data_type", "FAIL", "Expected int, but the column is missing"),
        ("wins data_type", "FAIL", "Expected int, but the column is missing"),
        ("Wins data_type", "PASS", "Expected Datatype"),
    ]


def test_schema_conformance_without_expectations(table):
    assert outcome(schema_conformance(table, [], "t")) == []


def test_extra_column_fails_the_column_count(table):
    assert outcome(column_count_check(table, 2, "t")) == [
        ("test_column_count", "FAIL", "Expected 2 columns, but got 3")
    ]
    assert outcome(column_count_check(table, 3, "t"))[0][1] == "PASS"


def test_results_share_a_schema(spark, table):
    checks = [
        schema_conformance(table, [("name", "string")], "t", "2024-01-01 10:00:00.25"),
        column_count_check(table, 3, "t", "2024-01-01 10:00:00.25"),
        primary_key_check(table, ["name"], "t", "2024-01-01 10:00:00.25"),
        row_count_drift(1, table, 10, "t", "2024-01-01 10:00:00.25"),
        row_count_floor(table, 1, "t", "2024-01-01 10:00:00.25"),
    ]
    for check in checks:
        assert [(f.name, f.dataType) for f in check.schema] == [
            (f.name, f.dataType) for f in RESULT_SCHEMA
        ]
    log = combine_results(*checks).collect()
    assert len(log) == 5
    assert {r["table_name"] for r in log} == {"t"}
    assert combine_results(*checks).selectExpr("cast(checked_at as string) s").first()["s"] == (
        "2024-01-01 10:00:00.25"
    )


def test_check_time_defaults_to_now(table):
    before = dt.datetime.now() - dt.timedelta(days=2)
    assert primary_key_check(table, ["name"], "t").first()["checked_at"] > before


def test_primary_key(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "a")], "a int, b string")
    assert outcome(primary_key_check(df, ["a", "b"], "t")) == [
        ("test_primary_key", "FAIL", "Total of 1 duplicate primary key values found")
    ]
    assert outcome(primary_key_check(df.distinct(), ["a", "b"], "t")) == [
        ("test_primary_key", "PASS", "")
    ]
    assert outcome(primary_key_check(df.limit(0), ["a"], "t")) == [("test_primary_key", "PASS", "")]


@pytest.mark.parametrize(
    ("before", "after", "threshold", "status", "reason"),
    [
        (100, 110, 10, "FAIL", ABOVE.format("10.0", 10)),
        (100, 109, 10, "PASS", BELOW.format(10)),
        (100, 50, 10, "PASS", BELOW.format(10)),
        (100, 100, 10, "PASS", BELOW.format(10)),
        (3, 7, 2.5, "FAIL", ABOVE.format((7 - 3) / 3 * 100, 2.5)),
        (0, 5, 10, "FAIL", "Count increased from 0 to 5"),
        (0, 0, 10, "PASS", BELOW.format(10)),
        (100, 100, 0, "FAIL", ABOVE.format("0.0", 0)),
    ],
)
@pytest.mark.parametrize("as_frame", [True, False])
def test_drift(spark, before, after, threshold, status, reason, as_frame):
    previous = spark.range(before) if as_frame else before
    assert outcome(row_count_drift(previous, spark.range(after), threshold, "t")) == [
        ("test_count_increase", status, reason)
    ]


def test_floor(spark):
    assert outcome(row_count_floor(spark.range(50), 100, "t")) == [
        ("test_count_floor", "FAIL", "Expected at least 100 rows, but got 50")
    ]
    assert outcome(row_count_floor(spark.range(100), 100, "t")) == [
        ("test_count_floor", "PASS", "Expected at least 100 rows")
    ]


@pytest.mark.parametrize("previous_rows", [0, 2, 4])
def test_combined_checks_equal_the_single_ones(spark, previous_rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    previous = spark.range(previous_rows)
    together = quality_checks(df, ["k"], "t", threshold=10, previous=previous, minimum=5)
    alone = combine_results(
        row_count_drift(previous, df, 10, "t"),
        primary_key_check(df, ["k"], "t"),
        row_count_floor(df, 5, "t"),
    )
    assert outcome(together) == outcome(alone)
    by_number = quality_checks(df, ["k"], "t", threshold=10, previous=previous_rows, minimum=5)
    assert outcome(by_number) == outcome(alone)
