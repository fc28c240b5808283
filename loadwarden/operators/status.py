"""From check results to one status per table, and from the ledger to an alert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadwarden.functions import run_day
from loadwarden.frames import small_frame
from loadwarden.labels import ALERT_FAILED, ALERT_MISSING, ALERT_PASSED, FAIL, MISSING, PASS


def _any(condition: Column) -> Column:
    """Whether any row meets the condition; false for no rows and for NULLs alone."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def status_rollup(
    results: DataFrame, test_type: str, run_date: dt.date | str | None = None
) -> DataFrame:
    """One ledger row per table: FAIL if any of its checks failed.

    The state per table is one flag, however many results it has.
    """
    return results.groupBy("table_name").agg(
        F.when(_any(F.col("status") == FAIL), FAIL).otherwise(PASS).alias("status"),
        F.lit(test_type).alias("test_type"),
        run_day(run_date).alias("date"),
    )


def status_gate(statuses: DataFrame) -> DataFrame:
    """One row, ``any_fail``: whether any status is FAIL in any letter case."""
    return statuses.agg(_any(F.upper("status") == FAIL).alias("any_fail"))


def merge_ledger(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The ledger with new rows added, each row once."""
    return existing.unionByName(new).distinct()


def _of_day(ledger: DataFrame, run_date: dt.date | str | None) -> DataFrame:
    return ledger if run_date is None else ledger.where(F.col("date") == run_day(run_date))


def with_missing(
    ledger: DataFrame, expected: Sequence[tuple[str, str]], run_date: dt.date | str | None = None
) -> DataFrame:
    """The ledger, of one day if one is given, and a MISSING row for each expected status it lacks.

    ``expected`` has pairs of table and test type; they come from a configuration and are few.
    """
    rows = _of_day(ledger, run_date)
    names = ["table_name", "test_type"]
    wanted = small_frame(
        ledger.sparkSession,
        [dict(zip(names, pair)) for pair in expected],
        StructType([StructField(name, StringType()) for name in names]),
    )
    missing = wanted.join(rows.select(*names).distinct(), names, "left_anti").select(
        "table_name",
        F.lit(MISSING).alias("status"),
        "test_type",
        (F.lit(None).cast("date") if run_date is None else run_day(run_date)).alias("date"),
    )
    return rows.unionByName(missing)


def load_alert(ledger: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """One row ``(any_fail, n_fail, message)`` over all dates or over one.

    A FAIL stays in the ledger when a later run of the day passes, and still alerts. So
    does a MISSING row of ``with_missing``.
    """
    failed = F.col("status").isin(FAIL, MISSING)
    message = F.when(F.col("any_fail") & F.col("_found"), ALERT_FAILED).when(
        F.col("any_fail"), ALERT_MISSING
    )
    return (
        _of_day(ledger, run_date)
        .agg(
            _any(failed).alias("any_fail"),
            F.count_if(failed).alias("n_fail"),
            _any(F.col("status") == FAIL).alias("_found"),
        )
        .select("any_fail", "n_fail", message.otherwise(ALERT_PASSED).alias("message"))
    )


def failing_rows(ledger: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """The ledger rows behind an alert."""
    return _of_day(ledger, run_date).where(F.col("status").isin(FAIL, MISSING))
