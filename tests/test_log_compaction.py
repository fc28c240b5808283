"""Logs whose many small files are put together while they are read and written."""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import StructType

from loadwarden import history
from loadwarden.commits import create_once, names_in
from loadwarden.history import Load, compact_history, read_loads, record_check, record_load, record_publishing
from loadwarden.operators import load_alert
from loadwarden.sinks import append_ledger
from loadwarden.sources import compact_ledger, read_ledger
from loadwarden.sources.ledger import COMMITS, SETTLED, SNAPSHOT_ROWS, SNAPSHOTS, STAGED, commit_ledger, settle_ledger, stored_ledger

DAY = dt.date(2024, 1, 1)
LEDGER = "table_name string, status string, test_type string, date date"


def day(k):
    return DAY + dt.timedelta(days=k)


def appended(spark, path, first, last):
    """Commits of one row each, as appends make them, without a Spark job for each."""
    staged = f"{path}/{STAGED}/by-hand-{first}"
    for k in range(first, last):
        folder = f"{staged}/date={day(k % 700)}"
        create_once(spark, f"{folder}/{k}.parquet", "")
        row = pa.table({"table_name": [f"t{k}"], "status": ["PASS"], "test_type": ["UnitTest"]})
        pq.write_table(row, f"{folder}/{k}.parquet")
        assert commit_ledger(spark, path, k, f"by-hand-{first}", [f"date={day(k % 700)}/{k}.parquet"])
    return {(f"t{k}", "PASS", "UnitTest", day(k % 700)) for k in range(first, last)}


def test_a_read_after_two_thousand_appends_opens_few_files(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    expected = appended(spark, path, 0, 2000)
    assert settle_ledger(spark, path) == 2000
    assert compact_ledger(spark, path, 100)
    assert not compact_ledger(spark, path, 100)  # nothing came since
    more = appended(spark, path, 2000, 2030)
    found = read_ledger(spark, path)
    assert {tuple(r) for r in found.collect()} == expected | more and found.count() == 2030
    assert len(found.inputFiles()) <= 30 + 4
    # What a snapshot covers is removed by a later one.
    assert compact_ledger(spark, path, 30, keep_seconds=0)
    assert len(names_in(spark, f"{path}/{COMMITS}")) == len(names_in(spark, f"{path}/{SETTLED}")) == 30
    assert len(list((tmp_path / "ledger").glob("date=*/*.parquet"))) == 30
    found = read_ledger(spark, path)
    assert {tuple(r) for r in found.collect()} == expected | more and len(found.inputFiles()) <= 4
    # A query for a day reads its rows by the snapshot's order.
    plan = load_alert(found, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(date,2024-01-01)" in plan


def test_appends_go_on_after_snapshots(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    new = [spark.createDataFrame([("t", "PASS", "UnitTest", day(k)), ("t", "PASS", "UnitTest", day(k + 1))], LEDGER) for k in range(4)]
    for k, frame in enumerate(new):
        append_ledger(frame, path)
        assert compact_ledger(spark, path, keep_seconds=0)
        assert settle_ledger(spark, path) == k + 1
        assert len(names_in(spark, f"{path}/{SNAPSHOTS}")) == len(names_in(spark, f"{path}/{SNAPSHOT_ROWS}")) == min(k + 1, 2)
    expected = [("t", "PASS", "UnitTest", day(k)) for k in range(5)]
    assert rows(stored_ledger(spark, path)) == expected
    assert rows(append_ledger(new[0], path)) == expected  # all of it is known
    assert settle_ledger(spark, path) == 4


def test_a_number_that_a_snapshot_covers_is_taken(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    for k in range(3):
        append_ledger(spark.createDataFrame([(f"t{k}", "PASS", "UnitTest", DAY)], LEDGER), path)
        compact_ledger(spark, path, keep_seconds=0)
    assert "0000000000" not in names_in(spark, f"{path}/{COMMITS}")
    # A slow writer that wanted number 0 before all of that.
    assert not commit_ledger(spark, path, 0, "slow", ["date=2024-01-01/x.parquet"])
    assert settle_ledger(spark, path) == 3
    assert rows(read_ledger(spark, path)) == [(f"t{k}", "PASS", "UnitTest", DAY) for k in range(3)]
    append_ledger(spark.createDataFrame([("late", "FAIL", "UnitTest", DAY)], LEDGER), path)
    assert compact_ledger(spark, path, keep_seconds=0) and "0000000000" not in names_in(spark, f"{path}/{COMMITS}")
    assert len(rows(read_ledger(spark, path))) == 4


def test_a_snapshot_that_was_killed_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    frame = spark.createDataFrame([("t", "PASS", "UnitTest", DAY)], LEDGER)
    append_ledger(frame, path)
    frame.limit(0).write.parquet(f"{path}/{SNAPSHOT_ROWS}/killed")
    assert rows(read_ledger(spark, path)) == rows(frame)
    assert compact_ledger(spark, path) and rows(read_ledger(spark, path)) == rows(frame)


def test_an_empty_ledger_has_nothing_to_put_together(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    assert not compact_ledger(spark, path) and rows(read_ledger(spark, path)) == []


def test_rows_from_before_there_were_commits_are_kept(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    old = spark.createDataFrame([("old", "FAIL", None, DAY), ("old", "FAIL", None, None)], LEDGER)
    old.write.partitionBy("date").parquet(path)
    append_ledger(spark.createDataFrame([("t", "PASS", "UnitTest", None)], LEDGER), path)
    before = rows(read_ledger(spark, path))
    for _ in range(2):
        compact_ledger(spark, path, keep_seconds=0)
        assert rows(read_ledger(spark, path)) == before and len(before) == 3
        append_ledger(old, path)


def test_writers_and_snapshots_at_the_same_time_lose_no_row(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    stop = threading.Event()

    def compacts():
        done = 0
        while not stop.is_set():
            done += compact_ledger(spark, path)
        return done

    def appends(w):
        for k in range(4):
            append_ledger(spark.createDataFrame([(f"w{w} {k}", "PASS", "UnitTest", day(k)), ("all", "PASS", "UnitTest", DAY)], LEDGER), path)

    with ThreadPoolExecutor(4) as pool:
        snapshots = pool.submit(compacts)
        try:
            list(pool.map(appends, range(3)))
        finally:
            stop.set()
        assert snapshots.result() >= 1
    expected = [(f"w{w} {k}", "PASS", "UnitTest", day(k)) for w in range(3) for k in range(4)]
    assert rows(read_ledger(spark, path)) == sorted([*expected, ("all", "PASS", "UnitTest", DAY)], key=repr)


# --- the history of loads


@pytest.fixture
def target(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = StructType().add("id", "long")
    for k in range(8):
        load = Load(f"load{k}", k, f"{target}-loads/load{k}", schema, False, False)
        record_load(spark, target, load)
        if k % 2:
            record_publishing(spark, target, load)
        if k == 5:
            record_check(spark, target, load)
    return target


def test_the_history_in_one_file_tells_the_same(spark, target):
    before = read_loads(spark, target)
    folder = f"{target}-loads/history"
    assert [load.num_rows for load in before] == list(range(8))
    assert not compact_history(spark, target, 14) and compact_history(spark, target, 13)
    assert len([n for n in names_in(spark, folder) if n.endswith(".parquet")]) == 1
    assert read_loads(spark, target) == before
    assert [load.checked for load in before].index(True) == 5


def test_a_new_load_puts_a_long_history_together(spark, target, monkeypatch):
    before = read_loads(spark, target)
    monkeypatch.setattr(history.compact_history, "__defaults__", (13,))
    load = Load("load8", 8, "x", before[0].columns, False, False)
    record_load(spark, target, load)
    assert len([n for n in names_in(spark, f"{target}-loads/history") if n.endswith(".parquet")]) == 2
    assert read_loads(spark, target) == [*before, load]


def test_a_history_put_together_by_two_and_broken_off(spark, target, tmp_path):
    before = read_loads(spark, target)
    # Killed after the new file was written: its events are there twice.
    folder = f"{target}-loads/history"
    spark.read.schema(history.HISTORY_SCHEMA).parquet(folder).coalesce(1).write.mode("append").parquet(folder)
    assert read_loads(spark, target) == before
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(read_loads, spark, target), pool.submit(compact_history, spark, target, 2)]:
            done.result()
    assert read_loads(spark, target) == before
