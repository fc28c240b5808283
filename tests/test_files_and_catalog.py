from __future__ import annotations

import datetime as dt

import tempfile
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from loadwarden.scratch import scratch_path
from loadwarden.sinks import overwrite_csv, overwrite_parquet, publish_table
from loadwarden.sources import (
    Source,
    describe_table,
    read_csv,
    read_parquet,
    read_source,
    read_table,
)


def test_csv_header_types_quotes_and_nulls(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text('id,name,note\n1,"Last, First",é\n2,trailing ,\n', encoding="utf-8")
    df = read_csv(spark, str(file))
    assert df.dtypes == [("id", "int"), ("name", "string"), ("note", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, "Last, First", "é"), (2, "trailing ", None)]


def test_csv_with_schema_reads_nothing_before_the_query(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text("id,name\n1,a\n")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    df = read_csv(spark, str(file), "id bigint, name string")
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert [tuple(r) for r in df.collect()] == [(1, "a")]


def test_csv_header_and_values_are_held_to_the_schema(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("name,id\nAsh,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(file), "id int, name string").collect()
    file.write_text("id,name\n1,Ash\nx,Birch\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(file), "id int, name string").collect()
    assert read_csv(spark, str(file), "id int, name string", mode="PERMISSIVE").count() == 2


def test_csv_round_trip_changes_no_text(spark, rows, tmp_path):
    texts = ["Elm ", " Elm", "", None, 'a "b", c', '"', "\\", 'x\\"y', "é,\t|", "''"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    path = str(tmp_path / "t")
    overwrite_csv(frame, path)
    assert rows(read_csv(spark, path, frame.schema)) == rows(frame)
    broken = spark.createDataFrame([(1, "a\nb"), (2, "c\r\nd")], frame.schema)
    with pytest.raises(Exception, match="line break"):
        overwrite_csv(broken, path)
    overwrite_csv(broken, path, multiLine=True)
    assert rows(read_csv(spark, path, frame.schema, multiLine=True)) == rows(broken)


def test_csv_keeps_microseconds(spark, rows, tmp_path):
    df = spark.sql(
        "select timestamp'2024-01-01 00:00:00.123456' a, timestamp_ntz'2024-01-01 00:00:00.654321' b"
    )
    overwrite_csv(df, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)


def test_source_renames(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text("Name,v\na,1\n")
    assert read_source(spark, Source(str(file), rename={"Name": "name"})).columns == ["name", "v"]
    with pytest.raises(ValueError, match="orc"):
        read_source(spark, Source(str(file), "orc"))


def test_parquet_with_every_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1).write.parquet(path)
    spark.range(1).selectExpr("id", "'x' as extra").write.mode("append").parquet(path)
    assert read_parquet(spark, path, mergeSchema=True).columns == ["id", "extra"]


def test_overwrite_leaves_nothing_behind(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    overwrite_parquet(spark.range(100), path)
    overwrite_parquet(spark.range(2), path)
    assert rows(read_parquet(spark, path)) == [(0,), (1,)]


def test_partitioned_overwrite_writes_few_files(spark, tmp_path):
    path = tmp_path / "p"
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "id % 4 as part")
    overwrite_parquet(df, str(path), ["part"])
    assert len(list(path.glob("part=*/*.parquet"))) <= 8
    assert read_parquet(spark, str(path)).count() == 4000


def test_file_size_bound(spark, tmp_path):
    path = tmp_path / "p"
    overwrite_parquet(spark.range(0, 100, 1, 1), str(path), max_records_per_file=30)
    assert len(list(path.glob("*.parquet"))) == 4


def test_publish_and_describe(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    overwrite_parquet(spark.range(3), path)
    assert publish_table(spark, "db_pub", "t", path).count() == 3
    assert spark.catalog.getTable("db_pub.t").tableType == "EXTERNAL"
    assert ("id", "bigint") in [tuple(r)[:2] for r in describe_table(spark, "db_pub", "t").collect()]
    assert rows(read_table(spark, "db_pub", "t")) == [(0,), (1,), (2,)]


def test_reload_shows_new_rows_and_columns(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    overwrite_parquet(spark.range(3), path)
    publish_table(spark, "db_reload", "t", path).count()
    overwrite_parquet(spark.range(1), path)
    assert rows(publish_table(spark, "db_reload", "t", path)) == [(0,)]
    overwrite_parquet(spark.range(1).selectExpr("id", "'x' as extra"), path)
    assert rows(publish_table(spark, "db_reload", "t", path)) == [(0, "x")]


def test_new_place_is_followed_and_old_files_stay(spark, rows, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    overwrite_parquet(spark.range(3), old)
    overwrite_parquet(spark.range(1), new)
    publish_table(spark, "db_move", "t", old)
    assert rows(publish_table(spark, "db_move", "t", new)) == [(0,)]
    assert read_parquet(spark, old).count() == 3


def test_partitions_follow_the_files(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    overwrite_parquet(spark.range(4).selectExpr("id", "id % 2 as part"), path, ["part"])
    assert publish_table(spark, "db_part", "t", path).count() == 4
    overwrite_parquet(spark.range(4).selectExpr("id", "id % 2 + 1 as part"), path, ["part"])
    table = publish_table(spark, "db_part", "t", path)
    assert rows(table.select("part").distinct()) == [(1,), (2,)]


def test_comments_and_properties_survive_a_reload(spark, rows, tmp_path):
    old, new, other = (str(tmp_path / name) for name in ("old", "new", "other"))
    overwrite_parquet(spark.range(3), old)
    publish_table(spark, "db_meta", "t", old)
    spark.sql("alter table db_meta.t set tblproperties ('owner.team' = 'a b')")
    spark.sql("alter table db_meta.t alter column id comment 'the id'")
    overwrite_parquet(spark.range(1).selectExpr("id", "'x' as extra"), new)
    assert rows(publish_table(spark, "db_meta", "t", new)) == [(0, "x")]
    overwrite_parquet(spark.range(1).selectExpr("'x' as extra", "id"), other)
    assert rows(publish_table(spark, "db_meta", "t", other)) == [("x", 0)]
    properties = {r["key"]: r["value"] for r in spark.sql("show tblproperties db_meta.t").collect()}
    assert properties["owner.team"] == "a b"
    assert spark.table("db_meta.t").schema["id"].metadata["comment"] == "the id"


def test_managed_table_is_never_dropped(spark, tmp_path):
    spark.sql("create database if not exists db_managed")
    spark.range(1).write.mode("overwrite").saveAsTable("db_managed.t")
    path = str(tmp_path / "t")
    overwrite_parquet(spark.range(3), path)
    with pytest.raises(ValueError, match="MANAGED"):
        publish_table(spark, "db_managed", "t", path)
    assert spark.table("db_managed.t").count() == 1


@pytest.mark.parametrize("name", ["a.b", "a b", "a`", "", "a;drop"])
def test_names_are_plain_identifiers(spark, tmp_path, name):
    with pytest.raises(ValueError, match="identifier"):
        publish_table(spark, name, "t", str(tmp_path))
    with pytest.raises(ValueError, match="identifier"):
        read_table(spark, "db", name)


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        publish_table(spark, "db_none", "t", str(tmp_path / "none"))


def test_scratch_goes_to_the_shared_folder():
    cluster = SimpleNamespace(
        conf={"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"},
        sparkContext=SimpleNamespace(applicationId="app-1"),
    )
    one, two = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert one.startswith("hdfs:///shared/loadwarden-app-1/x-") and one != two


def test_scratch_is_machine_local_only_in_a_local_session():
    application = SimpleNamespace(applicationId="app-1")
    local = SimpleNamespace(conf={"spark.master": "local[4]"}, sparkContext=application)
    assert scratch_path(local, "x").startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(SimpleNamespace(conf={"spark.master": "yarn"}), "x")


def test_scratch_setting_is_read_from_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is not None:
        assert scratch_path(spark, "x").startswith(shared)
