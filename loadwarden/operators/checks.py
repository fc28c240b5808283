"""Data checks. Each returns rows of ``RESULT_SCHEMA`` and runs nothing by itself.

A check that cannot confirm its expectation fails: a missing column is a FAIL
row, never a missing row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from loadwarden.frames import small_frame
from loadwarden.functions import check_time, percent_change, plain_number, text_of
from loadwarden.labels import (
    COLUMN_COUNT_TEST,
    COUNT_FLOOR_TEST,
    COUNT_INCREASE_TEST,
    DATA_TYPE_TEST_SUFFIX,
    DUPLICATE_KEYS,
    EXPECTED_TYPE,
    FAIL,
    INCREASE_ABOVE,
    INCREASE_BELOW,
    PASS,
    PRIMARY_KEY_TEST,
    UNEXPECTED_TYPE,
)
from loadwarden.manifest import manifest_counts
from loadwarden.operators.counts import key_counts, row_count

RESULT_SCHEMA = StructType(
    [
        StructField("table_name", StringType()),
        StructField("test_name", StringType()),
        StructField("status", StringType()),
        StructField("reason", StringType()),
        StructField("checked_at", TimestampType()),
    ]
)

Timestamp = dt.datetime | str | None


def _result(
    table_name: str,
    test_name: str,
    passed: Column,
    pass_reason: Column | str,
    fail_reason: Column | str,
    checked_at: Timestamp,
) -> Column:
    """One result row as a struct."""
    return F.struct(
        F.lit(table_name).alias("table_name"),
        F.lit(test_name).alias("test_name"),
        F.when(passed, PASS).otherwise(FAIL).alias("status"),
        F.when(passed, text_of(pass_reason)).otherwise(text_of(fail_reason)).alias("reason"),
        check_time(checked_at).alias("checked_at"),
    )


def _rows(measures: DataFrame, results: Sequence[Column]) -> DataFrame:
    """The result structs of a one-row frame as rows."""
    return measures.select(F.inline(F.array(*results)))


def combine_results(*results: DataFrame) -> DataFrame:
    """The rows of several checks as one check log."""
    return reduce(DataFrame.unionByName, results)


# --- checks on the schema: they read metadata only


def known_results(
    df: DataFrame,
    table_name: str,
    results: Sequence[tuple[str, bool, str]],
    checked_at: Timestamp,
) -> DataFrame:
    """Rows of ``(test, passed, reason)`` that the schema of ``df`` alone decides."""
    rows = [
        {
            "table_name": table_name,
            "test_name": test,
            "status": PASS if passed else FAIL,
            "reason": reason,
        }
        for test, passed, reason in results
    ]
    outcome = small_frame(df.sparkSession, rows, StructType(RESULT_SCHEMA.fields[:-1]))
    return outcome.withColumn("checked_at", check_time(checked_at))


def schema_conformance(
    df: DataFrame,
    expected: Sequence[tuple[str, str]],
    table_name: str,
    checked_at: Timestamp = None,
) -> DataFrame:
    """One row per expected ``(column, type)``; names are compared with case."""
    types = dict(df.dtypes)
    results = []
    for column, expected_type in expected:
        actual = types.get(column)
        if actual == expected_type:
            reason = EXPECTED_TYPE
        elif actual is None:
            reason = f"Expected {expected_type}, but the column is missing"
        else:
            reason = UNEXPECTED_TYPE.format(expected=expected_type, actual=actual)
        results.append((column + DATA_TYPE_TEST_SUFFIX, actual == expected_type, reason))
    return known_results(df, table_name, results, checked_at)


def column_count_check(
    df: DataFrame, expected_count: int, table_name: str, checked_at: Timestamp = None
) -> DataFrame:
    """FAIL unless the table has exactly ``expected_count`` columns."""
    count = len(df.columns)
    reason = f"Expected {expected_count} columns"
    if count != expected_count:
        reason += f", but got {count}"
    result = (COLUMN_COUNT_TEST, count == expected_count, reason)
    return known_results(df, table_name, [result], checked_at)


# --- checks on counts: each is a condition on one row of measures


def _primary_key_result(table_name: str, checked_at: Timestamp) -> Column:
    before, after = DUPLICATE_KEYS
    duplicates = F.col("num_duplicates")
    return _result(
        table_name,
        PRIMARY_KEY_TEST,
        duplicates == 0,
        "",
        text_of(before, duplicates, after),
        checked_at,
    )


def _missing_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys that are no column, in any letter case, as Spark finds columns."""
    known = {name.lower() for name in df.columns}
    return [key for key in keys if key.lower() not in known]


def _missing_keys_result(missing: list[str], table_name: str, checked_at: Timestamp) -> Column:
    reason = f"Key columns are missing: {', '.join(missing)}"
    return _result(table_name, PRIMARY_KEY_TEST, F.lit(False), reason, reason, checked_at)


def _drift_result(threshold: float, table_name: str, checked_at: Timestamp) -> Column:
    growth = percent_change(F.col("num_rows"), F.col("previous_rows"))
    before, after = INCREASE_ABOVE
    from_nothing = text_of("Count increased from 0 to ", F.col("num_rows"))
    return _result(
        table_name,
        COUNT_INCREASE_TEST,
        # Growth is NULL when there were no rows before: only no rows now passes.
        F.coalesce(growth < threshold, F.col("num_rows") == 0),
        INCREASE_BELOW.format(threshold=threshold),
        F.coalesce(text_of(before, plain_number(growth), after.format(threshold=threshold)), from_nothing),
        checked_at,
    )


def _floor_result(minimum: int, table_name: str, checked_at: Timestamp) -> Column:
    rows = F.col("num_rows")
    return _result(
        table_name,
        COUNT_FLOOR_TEST,
        rows >= minimum,
        f"Expected at least {minimum} rows",
        text_of(f"Expected at least {minimum} rows, but got ", rows),
        checked_at,
    )


def _with_previous(measures: DataFrame, previous: DataFrame | int | None) -> DataFrame:
    """``previous_rows`` beside one row of measures; without a previous table its own rows.

    The count of a previous table comes in by union and a final aggregate of two
    rows, since a join of two single rows has no key.
    """
    if previous is None:
        return measures.withColumn("previous_rows", F.col("num_rows"))
    if isinstance(previous, int):
        return measures.withColumn("previous_rows", F.lit(previous).cast("bigint"))
    both = measures.unionByName(row_count(previous, "previous_rows"), allowMissingColumns=True)
    return both.agg(*(F.max(name).alias(name) for name in both.columns))


def primary_key_check(
    df: DataFrame, keys: Sequence[str], table_name: str, checked_at: Timestamp = None
) -> DataFrame:
    """FAIL with the number of surplus rows unless every key is unique; NULL is a key value."""
    missing = _missing_keys(df, keys)
    if missing:
        return _rows(row_count(df), [_missing_keys_result(missing, table_name, checked_at)])
    return _rows(key_counts(df, keys), [_primary_key_result(table_name, checked_at)])


def row_count_drift(
    previous: DataFrame | int,
    current: DataFrame,
    threshold: float,
    table_name: str,
    checked_at: Timestamp = None,
) -> DataFrame:
    """FAIL if the table grew by ``threshold`` percent or more; shrinking passes.

    ``previous`` is the former table or its row count. A load that overwrites
    the table has to take it before it writes.
    """
    return _rows(
        _with_previous(row_count(current), previous),
        [_drift_result(threshold, table_name, checked_at)],
    )


def row_count_floor(
    df: DataFrame, minimum: int, table_name: str, checked_at: Timestamp = None
) -> DataFrame:
    """FAIL if fewer than ``minimum`` rows arrived."""
    return _rows(row_count(df), [_floor_result(minimum, table_name, checked_at)])


def quality_checks(
    df: DataFrame,
    keys: Sequence[str],
    table_name: str,
    *,
    threshold: float,
    previous: DataFrame | int | None = None,
    minimum: int | None = None,
    checked_at: Timestamp = None,
) -> DataFrame:
    """Key, growth and floor checks together, from one scan and one shuffle of the keys.

    Without a ``previous`` table the growth is that of the table over itself, none.
    """
    missing = _missing_keys(df, keys)
    key_result = _primary_key_result(table_name, checked_at)
    if missing:
        key_result = _missing_keys_result(missing, table_name, checked_at)
    results = [_drift_result(threshold, table_name, checked_at), key_result]
    if minimum is not None:
        results.append(_floor_result(minimum, table_name, checked_at))
    measures = row_count(df) if missing else key_counts(df, keys)
    return _rows(_with_previous(measures, previous), results)


def manifest_checks(
    manifest: DataFrame,
    table_name: str,
    *,
    threshold: float,
    previous: DataFrame | int | None = None,
    minimum: int | None = None,
    checked_at: Timestamp = None,
) -> DataFrame:
    """Growth and floor of a load from its manifest: no row of the table is read."""
    results = [_drift_result(threshold, table_name, checked_at)]
    if minimum is not None:
        results.append(_floor_result(minimum, table_name, checked_at))
    return _rows(_with_previous(manifest_counts(manifest).select("num_rows"), previous), results)
