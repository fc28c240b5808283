"""What the plans have to look like to hold on large tables."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

import __spark_entry__ as catalogue
from loadwarden.operators import (
    inner_join_using,
    key_counts,
    quality_checks,
    row_count_drift,
    status_rollup,
)
from loadwarden.session import MIB, sizing_conf
from loadwarden.sinks import overwrite_parquet

GIB = 1024 * MIB


@contextmanager
def settings(spark, conf):
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution left it, after the query ran."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A table in which one of 2,000 keys holds a third of the rows."""
    path = str(tmp_path_factory.mktemp("skew") / "facts")
    spark.range(0, 300_000, 1, 12).selectExpr(
        "if(id % 3 = 0, 0, id % 2000) as k", "id", "repeat(uuid(), 3) as payload"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_join_key_is_split(spark, skewed):
    keys = spark.range(0, 2000).selectExpr("id as k", "'x' as name")
    adaptive = "spark.sql.adaptive"
    small_cluster = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        f"{adaptive}.autoBroadcastJoinThreshold": "-1",
        f"{adaptive}.skewJoin.skewedPartitionThresholdInBytes": "1m",
        f"{adaptive}.skewJoin.skewedPartitionFactor": "2",
        f"{adaptive}.advisoryPartitionSizeInBytes": "512k",
        "spark.sql.shuffle.partitions": "16",
    }
    with settings(spark, small_cluster):
        joined = inner_join_using(skewed, keys, ["k"])
        final = final_plan(joined)
        assert joined.count() == 300_000
    assert "skew=true" in final


def test_only_a_small_side_is_broadcast(spark, skewed):
    keys = spark.range(0, 2000).selectExpr("id as k", "'x' as name")
    assert "BroadcastHashJoin" in plan(inner_join_using(skewed, keys, ["k"]))
    assert "SortMergeJoin" in plan(inner_join_using(skewed, skewed, ["k", "id"]))


def test_hot_key_is_counted_before_the_shuffle(skewed):
    text = plan(key_counts(skewed, ["k"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan") == 1
    shuffle = text.index("Exchange hashpartitioning")
    assert "partial_count(1)" in text[shuffle:]
    assert "ReadSchema: struct<k:bigint>" in text


def test_combined_checks_scan_and_shuffle_once(skewed):
    text = plan(quality_checks(skewed, ["k", "id"], "t", threshold=10, previous=5, minimum=1))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_drift_reads_no_column_and_joins_nothing(skewed):
    text = plan(row_count_drift(skewed, skewed, 10, "t"))
    assert text.count("ReadSchema: struct<>") == 2
    assert "Join" not in text and "Cartesian" not in text


def test_rollup_keeps_one_flag_per_table(skewed):
    results = skewed.selectExpr("cast(k as string) as table_name", "payload as status")
    text = plan(status_rollup(results, "UnitTest"))
    assert "collect" not in text
    assert "partial_max" in text


def test_hot_partition_is_written_by_several_tasks(spark, skewed, tmp_path):
    path = tmp_path / "out"
    small_cluster = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": "8",
    }
    with settings(spark, small_cluster):
        overwrite_parquet(skewed.selectExpr("id", "payload", "k = 0 as hot"), str(path), ["hot"])
    assert len(list(path.glob("hot=true/*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 300_000


def test_sizing():
    small, large = sizing_conf(10 * GIB), sizing_conf(100 * 1024 * GIB)
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MIB)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.files.maxPartitionBytes"] == str(100 * 1024 * GIB // 100_000)
    assert large["spark.sql.shuffle.partitions"] == str(100 * 1024 * 2)
    wide = sizing_conf(100 * 1024 * GIB, bytes_per_reducer=GIB)
    assert wide["spark.sql.shuffle.partitions"] == str(100 * 1024)


NO_PYTHON = re.compile(r"PythonUDF|ArrowEval|BatchEvalPython|MapInPandas|PythonRDD")


@pytest.mark.parametrize("name", sorted(catalogue.library_queries()))
def test_no_query_leaves_the_jvm_or_pairs_rows_without_a_key(spark, name):
    text = plan(catalogue.library_queries()[name](spark, "/root/testdata/sf0.001"))
    assert not NO_PYTHON.search(text)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
