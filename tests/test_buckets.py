"""Tables laid out by their keys: counts and joins by the keys need no shuffle."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest

from loadwarden.config import LoadConfig
from loadwarden.history import read_loads
from loadwarden.manifest import bucket_rows
from loadwarden.operators import duplicate_keys, key_counts
from loadwarden.plans import daily_run, load_manifest, load_pipeline, quality_job, rows_by_key
from loadwarden.sinks import Buckets, overwrite_buckets, overwrite_parquet, publish_table
from loadwarden.sources import Source

DAY = dt.date(2024, 1, 1)
LOAD_TS = "2024-01-01 06:00:00"


@pytest.fixture
def config(spark, tmp_path, request):
    spark.range(0, 4000, 1, 3).selectExpr("id", "cast(id % 3 as string) as side").write.parquet(str(tmp_path / "left"))
    spark.range(0, 4000, 1, 2).selectExpr("id", "id * 2 as twice").write.parquet(str(tmp_path / "right"))
    return LoadConfig(
        left=Source(str(tmp_path / "left"), "parquet"),
        right=Source(str(tmp_path / "right"), "parquet"),
        join_on=["id"],
        database="db_buckets_" + "".join(c for c in request.node.name if c.isalnum()).lower(),
        table="t",
        target_path=str(tmp_path / "out" / "t"),
        results_path=str(tmp_path / "monitoring"),
        ledger_path=str(tmp_path / "monitoring" / "ledger"),
        key_columns=["id"],
        expected_columns=[("id", "bigint"), ("side", "string"), ("twice", "bigint"), ("batch_id", "string"), ("load_date", "string")],
        bucket_by=["id"],
        num_buckets=6,
    )


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles_by_key(df):
    return plan(df).count("hashpartitioning")


def test_key_counts_of_the_published_table_need_no_shuffle(spark, rows, config):
    load_pipeline(spark, config, LOAD_TS)
    (load,) = read_loads(spark, config.target_path)
    assert load.buckets == Buckets(("id",), 6) and load.num_rows == 4000
    table, plain = rows_by_key(spark, config, load), load.read(spark)
    for count in (key_counts, duplicate_keys):
        assert shuffles_by_key(count(table, ["id"])) == 0 < shuffles_by_key(count(plain, ["id"]))
        assert rows(count(table, ["id"])) == rows(count(plain, ["id"]))
    # More keys than the buckets are made of need none either; other ones do.
    assert shuffles_by_key(key_counts(table, ["side", "id"])) == 0 < shuffles_by_key(key_counts(table, ["side"]))
    assert rows(table) == rows(plain)
    counts = {r.bucket: r.num_rows for r in bucket_rows(load_manifest(spark, config)).collect()}
    assert set(counts) == set(range(6)) and sum(counts.values()) == 4000


def test_joins_by_the_key_need_no_shuffle(spark, rows, config):
    table = load_pipeline(spark, config, LOAD_TS)
    other = dataclasses.replace(config, table="u", target_path=config.target_path + "u")
    also = load_pipeline(spark, other, LOAD_TS).select("id", "twice")
    joined = table.select("id", "side").hint("merge").join(also, "id")
    assert "Exchange" not in plan(joined) and joined.count() == 4000


def test_reloads_move_the_table_and_other_buckets_define_it_anew(spark, rows, config, tmp_path):
    load_pipeline(spark, config, LOAD_TS)
    for one in (config, dataclasses.replace(config, num_buckets=3), dataclasses.replace(config, bucket_by=(), num_buckets=None), config):
        table = load_pipeline(spark, one, LOAD_TS)
        load = read_loads(spark, config.target_path)[-1]
        assert rows(table) == rows(load.read(spark)) and (load.buckets is None) == (one.num_buckets is None)
        counted = key_counts(rows_by_key(spark, one, load), ["id"])
        assert counted.first()[:3] == (4000, 4000, 0)
        assert (shuffles_by_key(counted) > 0) == (one.num_buckets is None)
    names = {t.name for t in spark.catalog.listTables(config.database)}
    assert names == {"t"}  # no definition of a write is left


def test_a_daily_run_checks_by_buckets(spark, config):
    run = daily_run(spark, config, DAY, LOAD_TS)
    assert not run.alert.first().any_fail and run.quality.count() == 2
    assert {r.status for r in quality_job(spark, config, None, DAY).collect()} == {"PASS"}


def test_a_hot_key_is_counted_from_the_plain_files(spark, rows, config, tmp_path):
    hot = "case when id % 3 = 0 then 7 else id end as id"
    spark.range(0, 4000, 1, 3).selectExpr(hot, "'x' as side").write.parquet(str(tmp_path / "hot"))
    config = dataclasses.replace(config, left=Source(str(tmp_path / "hot"), "parquet"))
    load_pipeline(spark, config, LOAD_TS)
    (load,) = read_loads(spark, config.target_path)
    table = rows_by_key(spark, config, load)
    assert load.num_rows == 4000 and "Bucketed: true" not in plan(key_counts(table, ["id"]))
    assert rows(duplicate_keys(table, ["id"])) == [(7, 1335)]
    outcome = {r.test_name: r.status for r in quality_job(spark, config, None, DAY).collect()}
    assert outcome["test_primary_key"] == "FAIL"


def test_a_hot_bucket_is_written_by_several_tasks(spark, rows, tmp_path):
    path = str(tmp_path / "hot")
    many = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) as k", "sha2(string(id), 512) as payload")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200KB")
    try:
        overwrite_buckets(many, path, Buckets(("k",), 4), "db_hot_bucket")
    finally:
        spark.conf.set(size, before)
    table = publish_table(spark, "db_hot_bucket", "t", path, many.schema, (), Buckets(("k",), 4))
    files = table.where("k = 7").selectExpr("_metadata.file_path as f").groupBy("f").count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 15000
    assert rows(key_counts(table, ["k"])) == [(60000, 40000, 20000)]


def test_nulls_empty_tables_and_odd_names(spark, rows, tmp_path):
    frame = spark.sql("select if(id < 5, null, id) as `a k`, string(id) as `b``c` from range(20)")
    buckets = Buckets(("a k", "b`c"), 3)
    for k, one in enumerate((frame, frame.limit(0), frame)):
        path = str(tmp_path / str(k))
        overwrite_buckets(one, path, buckets, "db_odd_buckets")
        table = publish_table(spark, "db_odd_buckets", "t", path, one.schema, (), buckets)
        assert rows(table) == rows(one)
        assert shuffles_by_key(table.groupBy("`a k`", "`b``c`").count()) == 0
    overwrite_parquet(frame, str(tmp_path / "plain"))
    assert rows(publish_table(spark, "db_odd_buckets", "t", str(tmp_path / "plain"), frame.schema)) == rows(frame)


def test_settings_that_do_not_go_together(config):
    for wrong in ({"num_buckets": None}, {"bucket_by": ()}, {"num_buckets": 0}, {"partition_by": ("side",)}, {"bucket_by": "id"}):
        with pytest.raises(ValueError):
            dataclasses.replace(config, **wrong)
