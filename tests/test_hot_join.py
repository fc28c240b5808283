"""Joins of keys that are hot on both sides."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadwarden.operators import hot_keys, inner_join_hot, inner_join_using, joins


@pytest.fixture
def without_adaptive(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def sides(spark, tmp_path, n_left=6000, n_right=4500):
    for name, n in (("l", n_left), ("r", n_right)):
        spark.range(0, n, 1, 3).selectExpr("if(id % 3 = 0, 0, id) as k", f"id as {name}", "'x' as own_rows" if name == "l" else "1 as _key").write.parquet(str(tmp_path / name))
    return (spark.read.parquet(str(tmp_path / name)) for name in "lr")


def test_a_key_with_a_third_of_both_sides_is_dealt_to_all_tasks(spark, tmp_path, without_adaptive):
    left, right = sides(spark, tmp_path)
    joined = inner_join_hot(left, right, ["k"], cell_rows=10_000)
    assert joined.columns == inner_join_using(left, right, ["k"]).columns
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2000 * 1500 + 3000
    assert len(tasks) == 4 and max(tasks) <= 2 * sorted(tasks)[1]
    plain = [r["count"] for r in inner_join_using(left, right, ["k"]).groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > 2 * sorted(plain)[1]
    pairs = joined.where("k = 0").agg(F.count_distinct("l", "r"), F.count("k")).first()
    assert tuple(pairs) == (3_000_000, 3_000_000)


def test_hot_keys_are_those_of_both_sides(spark, tmp_path):
    left, right = sides(spark, tmp_path)
    ((key, rows, columns),) = hot_keys(left, right, ["k"], cell_rows=10_000)
    assert key == spark.sql("select xxhash64(0L)").first()[0]
    assert (rows, columns) == (20, 15)
    assert hot_keys(left, right, ["k"], cell_rows=2000 * 1500) == []
    # One row in the other side: no row is copied more than it needs.
    one = right.where("k > 0").limit(5).union(right.where("k = 0").limit(1))
    ((_, rows, columns),) = hot_keys(left, one, ["k"], cell_rows=100)
    assert (rows, columns) == (20, 1)
    assert hot_keys(left.limit(0), right, ["k"], cell_rows=1) == []


def test_copies_are_few_and_never_broadcast(spark, tmp_path):
    left, right = sides(spark, tmp_path)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = inner_join_hot(left, right, ["k"], cell_rows=1)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # The two that are left have the grid.
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert joined.count() == 2000 * 1500 + 3000
    ((_, rows, columns),) = hot_keys(left, right, ["k"], cell_rows=1, most_cells=64 * partitions)
    assert 64 * partitions <= rows * columns <= 2 * 64 * partitions
    assert plan.count(f",{rows},{columns}]") == 2
    assert hot_keys(left, right, ["k"], cell_rows=1)[0][1:] == (2000, 1500)


def test_cells_do_not_grow_by_64_for_each_partition(spark, tmp_path):
    left, right = sides(spark, tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        plan = inner_join_hot(left, right, ["k"], cell_rows=1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ((_, rows, columns),) = hot_keys(left, right, ["k"], cell_rows=1, most_cells=4 * 200)
    assert 4 * 200 <= rows * columns <= 2 * 4 * 200
    assert plan.count(f",{rows},{columns}]") == 2
    # Packing the right's rows takes no shuffle of its own.
    assert plan.count("Exchange hashpartitioning") == 2


def test_short_runs_of_the_right_come_again_and_again(spark, tmp_path, monkeypatch):
    left, right = sides(spark, tmp_path, 600, 600)
    monkeypatch.setattr(joins, "PACKED_ROWS", 30)
    found = inner_join_hot(left, right, ["k"], cell_rows=5000).where("k = 0").select(F.spark_partition_id(), "l", "r").collect()
    assert len({(r.l, r.r) for r in found}) == len(found) == 200 * 200
    windows = [found[i : i + 60] for i in range(0, len(found), 60)]
    within = sorted(len({r.r for r in window}) for window in windows)
    # Row by row of the left, a window would have a value of its own in nearly every row.
    assert within[len(within) // 2] <= 20


def test_columns_are_those_of_the_plain_join(spark, tmp_path):
    left, right = sides(spark, tmp_path, 60, 60)
    left, right = left.withColumn("x", F.col("l") + 1), right.selectExpr("k as K", "r", "array(r, null) as x", "_key as _packed")
    for one, other in ((left, right), (left, right.select("K")), (left.select("k"), right), (right, left)):
        found, plain = (join(one, other, ["k"], **more) for join, more in ((inner_join_hot, {"cell_rows": 5}), (inner_join_using, {})))
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in plain.schema]
        assert Counter(map(str, found.collect())) == Counter(map(str, plain.collect()))


@given(st.lists(st.tuples(st.sampled_from([None, 0, 0, 0, 1, 2]), st.sampled_from(["a", "a", None])), max_size=25),
       st.lists(st.tuples(st.sampled_from([None, 0, 0, 1, 3]), st.sampled_from(["a", "a", None])), max_size=25))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_rows_are_those_of_the_plain_join(spark, ls, rs):
    left = spark.createDataFrame([(*key, n) for n, key in enumerate(ls)], "a int, b string, n int")
    right = spark.createDataFrame([(*key, n) for n, key in enumerate(rs)], "a int, b string, m int")
    found = Counter(tuple(r) for r in inner_join_hot(left, right, ["a", "b"], cell_rows=3).collect())
    expected = Counter((*k, n, m) for n, k in enumerate(ls) for m, o in enumerate(rs) if k == o and None not in k)
    assert found == expected


def test_keys_that_cannot_be_hashed_alike(spark):
    one, other = spark.range(1), spark.range(1).selectExpr("cast(id as int) as id")
    with pytest.raises(ValueError, match="bigint and int"):
        inner_join_hot(one, other, ["id"])
    double = spark.range(1).selectExpr("cast(id as double) as id")
    with pytest.raises(ValueError, match="floating"):
        inner_join_hot(double, double, ["id"])
