from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadwarden.operators import add_audit_columns, inner_join_using, rename_columns


def test_rename_keeps_position(spark):
    df = spark.createDataFrame([(1, "a")], "Name int, Side string")
    assert rename_columns(df, {"Name": "name"}).columns == ["name", "Side"]


def test_rename_of_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="Nam"):
        rename_columns(spark.range(1), {"Nam": "name"})


def test_key_comes_once_and_first(spark):
    left = spark.createDataFrame([(1, "x")], "id int, name string")
    right = spark.createDataFrame([("x", 7)], "name string, wins int")
    assert inner_join_using(left, right, ["name"]).columns == ["name", "id", "wins"]


def test_duplicates_multiply_and_null_keys_drop(spark, rows):
    left = spark.createDataFrame([(1, "n"), (2, "j"), (3, "j"), (4, None)], "id int, name string")
    right = spark.createDataFrame([("n", 1), ("n", 2), ("j", 3), (None, 4)], "name string, v int")
    assert rows(inner_join_using(left, right, ["name"])) == [
        ("j", 2, 3),
        ("j", 3, 3),
        ("n", 1, 1),
        ("n", 1, 2),
    ]


def test_text_keys_match_exactly(spark):
    left = spark.createDataFrame([("k ",), ("K",), ("é",)], "name string")
    right = spark.createDataFrame([("k", 1), ("é", 2)], "name string, v int")
    assert [tuple(r) for r in inner_join_using(left, right, ["name"]).collect()] == [("é", 2)]


keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=12)


@settings(max_examples=8, deadline=None)
@given(keys, keys)
def test_join_rows_are_products_of_multiplicities(spark, left, right):
    joined = inner_join_using(
        spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, l int"),
        spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k int, r int"),
        ["k"],
    )
    on_left, on_right = Counter(left), Counter(right)
    expected = sum(n * on_right[k] for k, n in on_left.items() if k is not None)
    assert joined.count() == expected


def test_audit_columns(spark):
    df = add_audit_columns(spark.range(2), load_ts=dt.datetime(2024, 1, 1, 2, 3, 4, 500000))
    assert df.dtypes == [("id", "bigint"), ("batch_id", "string"), ("load_date", "string")]
    assert {tuple(r)[1:] for r in df.collect()} == {("101", "2024-01-01 02:03:04.5")}


def test_given_load_time_ignores_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = add_audit_columns(spark.range(1), load_ts="2024-01-01 00:00:00")
        assert df.first()["load_date"] == "2024-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_current_load_time_is_one_value(spark):
    df = add_audit_columns(spark.range(0, 1000, 1, 4), batch_id="7")
    assert df.select("batch_id", "load_date").distinct().count() == 1
