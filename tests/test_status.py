from __future__ import annotations

import datetime as dt

import pytest

from loadwarden.labels import ALERT_MISSING
from loadwarden.operators import (
    failing_rows,
    load_alert,
    merge_ledger,
    status_gate,
    status_rollup,
    with_missing,
)
from loadwarden.sinks import append_ledger, write_ledger_csv, write_results
from loadwarden.sources import read_ledger, read_ledger_csv, read_results

DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
LEDGER = "table_name string, status string, test_type string, date date"
FAILED = (
    "Please check Data Quality log for detailed failures. "
    "Please find the attached table log for details."
)
PASSED = "Data Quality Job completed successfully without failures."


def ledger_of(spark, *data):
    return spark.createDataFrame(list(data), LEDGER)


def test_rollup(spark, rows):
    results = spark.createDataFrame(
        [("a", "PASS"), ("a", "FAIL"), ("b", "PASS"), ("c", None), ("d", "fail"), (None, "FAIL")],
        "table_name string, status string",
    )
    assert rows(status_rollup(results, "UnitTest", DAY1)) == [
        ("a", "FAIL", "UnitTest", DAY1),
        ("b", "PASS", "UnitTest", DAY1),
        ("c", "PASS", "UnitTest", DAY1),
        ("d", "PASS", "UnitTest", DAY1),
        (None, "FAIL", "UnitTest", DAY1),
    ]


def test_rollup_is_dated_today(spark):
    results = spark.createDataFrame([("a", "PASS")], "table_name string, status string")
    today = spark.range(1).selectExpr("current_date() d").first()["d"]
    assert status_rollup(results, "UnitTest").first()["date"] == today


def test_gate_ignores_case(spark):
    statuses = [[], ["PASS"], [None], ["PASS", "fail"], ["FAIL"]]
    gates = [
        status_gate(spark.createDataFrame([(s,) for s in group], "status string")).first()[0]
        for group in statuses
    ]
    assert gates == [False, False, False, True, True]


def test_ledger_is_created_and_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    today = ledger_of(spark, ("t", "PASS", "UnitTest", DAY1), ("t", "FAIL", "DataQuality", DAY1))
    assert rows(read_ledger(spark, path)) == []
    first = rows(append_ledger(today, path))
    assert first == rows(today)
    files = sorted(tmp_path.glob("ledger/date=*/*.parquet"))
    assert rows(append_ledger(today, path)) == first
    assert sorted(tmp_path.glob("ledger/date=*/*.parquet")) == files


def test_new_status_of_the_day_keeps_both_rows_and_alerts(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    append_ledger(ledger_of(spark, ("t", "FAIL", "UnitTest", DAY1)), path)
    ledger = append_ledger(ledger_of(spark, ("t", "PASS", "UnitTest", DAY1)), path)
    assert ledger.count() == 2
    assert rows(load_alert(ledger, DAY1)) == [(True, 1, FAILED)]


def test_nulls_in_the_ledger_are_compared_as_values(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    new = ledger_of(spark, (None, "PASS", "UnitTest", DAY1))
    append_ledger(new, path)
    assert rows(append_ledger(new, path)) == [(None, "PASS", "UnitTest", DAY1)]


def test_rows_written_twice_by_two_writers_are_read_once(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    new = ledger_of(spark, ("t", "PASS", "UnitTest", DAY1))
    for _ in range(2):
        new.write.mode("append").partitionBy("date").parquet(path)
    assert rows(read_ledger(spark, path)) == [("t", "PASS", "UnitTest", DAY1)]


def test_broken_ledger_is_an_error(spark, tmp_path):
    (tmp_path / "ledger").mkdir()
    (tmp_path / "ledger" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_ledger(spark, str(tmp_path / "ledger")).count()


def test_merge(spark, rows):
    one = ledger_of(spark, ("t", "PASS", "UnitTest", DAY1), ("t", "PASS", "UnitTest", DAY2))
    # Matched by name, not by position.
    two = one.where("date = '2024-01-01'").select("date", "test_type", "status", "table_name")
    assert rows(merge_ledger(one, two)) == rows(one)


def test_alert_scope(spark, rows):
    ledger = ledger_of(spark, ("t", "FAIL", "UnitTest", DAY1), ("t", "PASS", "UnitTest", DAY2))
    assert rows(load_alert(ledger)) == [(True, 1, FAILED)]
    assert rows(load_alert(ledger, DAY2)) == [(False, 0, PASSED)]
    assert rows(load_alert(ledger, "2024-01-01")) == [(True, 1, FAILED)]
    assert rows(failing_rows(ledger)) == [("t", "FAIL", "UnitTest", DAY1)]
    assert rows(failing_rows(ledger, DAY2)) == []


def test_alert_takes_the_exact_case_and_an_empty_ledger(spark, rows):
    assert rows(load_alert(ledger_of(spark, ("t", "fail", "UnitTest", DAY1)))) == [
        (False, 0, PASSED)
    ]
    # Nothing was expected of this ledger; what is expected and missing alerts.
    assert rows(load_alert(ledger_of(spark))) == [(False, 0, PASSED)]
    watched = with_missing(ledger_of(spark), [("t", "UnitTest"), ("t", "DataQuality")], DAY1)
    assert rows(load_alert(watched)) == [(True, 2, ALERT_MISSING)]
    assert rows(failing_rows(watched)) == [
        ("t", "MISSING", "DataQuality", DAY1),
        ("t", "MISSING", "UnitTest", DAY1),
    ]


def test_what_is_missing_of_a_day(spark, rows):
    ledger = ledger_of(spark, ("t", "PASS", "UnitTest", DAY1), ("u", "FAIL", "UnitTest", DAY2))
    expected = [("t", "UnitTest"), ("u", "UnitTest")]
    assert rows(with_missing(ledger, expected)) == rows(ledger)
    assert rows(with_missing(ledger, expected, DAY1)) == [
        ("t", "PASS", "UnitTest", DAY1),
        ("u", "MISSING", "UnitTest", DAY1),
    ]
    assert rows(load_alert(with_missing(ledger, expected, DAY2))) == [(True, 2, FAILED)]


def test_one_day_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "ledger")
    append_ledger(ledger_of(spark, ("t", "FAIL", "UnitTest", DAY1)), path)
    append_ledger(ledger_of(spark, ("t", "PASS", "UnitTest", DAY2)), path)
    alert = load_alert(read_ledger(spark, path), DAY2)
    plan = alert._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_ledger_csv_has_headings_and_comes_back(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    ledger = ledger_of(spark, ("t", "PASS", "UnitTest", DAY1), ("t", "FAIL", "DataQuality", DAY2))
    write_ledger_csv(ledger.coalesce(1), path)
    (file,) = (tmp_path / "csv").glob("part-*")
    assert file.read_text().splitlines()[0] == "Table Name,Status,Test Type,Date"
    assert rows(read_ledger_csv(spark, path)) == rows(ledger)


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_results_come_back_and_are_replaced(spark, rows, tmp_path, format):
    path = str(tmp_path / "results")
    results = spark.sql(
        "select 't' table_name, 'x' test_name, 'PASS' status, '' reason,"
        " timestamp'2023-09-18 21:46:42.176586' checked_at"
        " union all select 't', 'y', 'FAIL', 'a, \"b\"', null"
    )
    write_results(results.limit(1), path, format)
    write_results(results, path, format)
    assert rows(read_results(spark, path, format)) == rows(results)


def test_unknown_results_format(spark, tmp_path):
    with pytest.raises(ValueError, match="orc"):
        write_results(spark.range(1), str(tmp_path / "r"), "orc")
    with pytest.raises(ValueError, match="orc"):
        read_results(spark, str(tmp_path / "r"), "orc")
