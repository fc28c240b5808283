from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

from loadwarden.frames import empty_frame, small_frame

SCHEMA = StructType([StructField("name", StringType()), StructField("n", LongType())])


def test_empty_frame(spark):
    df = empty_frame(spark, SCHEMA)
    assert df.dtypes == [("name", "string"), ("n", "bigint")]
    assert df.collect() == []


def test_small_frame_keeps_texts(spark):
    rows = [
        {"name": "it's \"quoted\", \\ and é\n", "n": 2**60},
        {"name": "", "n": 0},
        {"name": None, "n": None},
    ]
    df = small_frame(spark, rows, SCHEMA)
    assert df.dtypes == [("name", "string"), ("n", "bigint")]
    assert [row.asDict() for row in df.collect()] == rows
    assert df.rdd.getNumPartitions() == 1


def test_small_frame_without_rows(spark):
    assert small_frame(spark, [], SCHEMA).collect() == []
