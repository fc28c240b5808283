from __future__ import annotations

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from loadwarden.operators import (
    distinct_key_count,
    duplicate_keys,
    group_count,
    key_counts,
    row_count,
)

KEYS = [(1, None), (1, None), (None, None), (2, "a")]


def test_null_is_a_key_value(spark, rows):
    df = spark.createDataFrame(KEYS, "a int, b string")
    assert rows(distinct_key_count(df, ["a", "b"])) == [(3,)]
    assert rows(key_counts(df, ["a", "b"])) == [(4, 3, 1)]
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, None, 2)]


def test_null_is_a_group(spark, rows):
    df = spark.createDataFrame([("good",), (None,), (None,)], "side string")
    assert rows(group_count(df, ["side"], "total")) == [("good", 1), (None, 2)]


def test_empty_table(spark, rows):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(row_count(df)) == [(0,)]
    assert rows(distinct_key_count(df, ["a"])) == [(0,)]
    assert rows(key_counts(df, ["a"])) == [(0, 0, 0)]
    assert rows(duplicate_keys(df, ["a"])) == []


pairs = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["x", "y", None]))


@settings(max_examples=8, deadline=None)
@given(st.lists(pairs, max_size=20))
def test_counts_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "a int, b string")
    counts = Counter(data)
    assert tuple(key_counts(df, ["a", "b"]).first()) == (
        len(data),
        len(counts),
        len(data) - len(counts),
    )
    assert {tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()} == {
        (*key, n) for key, n in counts.items() if n > 1
    }
