from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadwarden.functions import (
    check_time,
    load_stamp,
    percent_change,
    plain_number,
    run_day,
    text_of,
)


def values(spark, numbers, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    return [row[1] for row in df.select("i", column).orderBy("i").collect()]


def test_plain_number(spark):
    numbers = [0.0, 10.0, 0.5, 120.58823529411765, 100 / 3, 1e7, 19999900.0, 123456789012.25, -2.5]
    assert values(spark, numbers, plain_number(F.col("x"))) == [repr(x) for x in numbers]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**6), st.integers(1, 10**12)), min_size=1))
def test_growth_reads_like_a_python_number(spark, counts):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(counts)], "i int, p long, c long")
    growth = percent_change(F.col("c"), F.col("p"))
    texts = df.select("i", plain_number(growth)).orderBy("i").collect()
    for (previous, current), (_, text) in zip(counts, texts):
        expected = (current - previous) / previous * 100
        assert float(text) == pytest.approx(expected, abs=1e-16)
        assert "E" not in text


def test_growth_from_nothing_is_unknown(spark):
    df = spark.createDataFrame([(0, 5), (0, 0), (4, 3)], "p long, c long")
    grown = df.select(percent_change(F.col("c"), F.col("p"))).collect()
    assert [row[0] for row in grown] == [None, None, -25.0]


def test_text(spark):
    row = spark.range(7, 8).select(text_of("n = ", F.col("id"), "; ", 1.5)).first()
    assert row[0] == "n = 7; 1.5"


def test_days_and_stamps(spark):
    row = spark.range(1).select(
        run_day("2024-02-29"),
        run_day(dt.datetime(2024, 2, 29, 23, 59)),
        load_stamp("2024-02-29 01:02:03"),
        load_stamp(dt.datetime(2024, 2, 29, 1, 2, 3, 4)),
        run_day() == F.current_date(),
        load_stamp() == F.current_timestamp().cast("string"),
    )
    day = dt.date(2024, 2, 29)
    stamps = ("2024-02-29 01:02:03", "2024-02-29 01:02:03.000004")
    assert tuple(row.first()) == (day, day, *stamps, True, True)


@pytest.mark.parametrize("function", [run_day, load_stamp, check_time])
def test_what_is_no_time_is_an_error(spark, function):
    with pytest.raises(ValueError, match="2024-02-30|day is out of range"):
        function("2024-02-30")


def test_check_time_may_have_an_offset(spark):
    df = spark.range(1).select(check_time("2024-01-01 02:00:00+02:00").cast("string"))
    assert df.first()[0] == "2024-01-01 00:00:00"
