"""The five daily jobs and their chain. An error in a job reaches the caller."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loadwarden.config import LoadConfig
from loadwarden import journal as steps
from loadwarden.history import Load, baseline, read_loads, record_check
from loadwarden.labels import DATA_QUALITY, UNIT_TEST
from loadwarden.operators import (
    column_count_check,
    combine_results,
    load_alert,
    quality_checks,
    schema_conformance,
    status_rollup,
    with_missing,
)
from loadwarden.plans.load import (
    loaded,
    publish,
    published_loads,
    remove_old_loads,
    rows_by_key,
    script_params,
    script_text,
    write_load,
)
from loadwarden.plans.script import run_sql_script
from loadwarden.sinks import append_ledger, overwrite_parquet, write_results
from loadwarden.sources import compact_ledger, read_ledger, read_parquet, read_results

logger = logging.getLogger(__name__)

Day = dt.date | str | None
Timestamp = dt.datetime | str | None


@dataclass(frozen=True)
class DailyRun:
    """What each job of a daily run left behind; all frames but the analytics are small."""

    table: DataFrame
    analytics: Sequence[DataFrame]
    unit_tests: DataFrame
    quality: DataFrame
    ledger: DataFrame
    alert: DataFrame


def analytics_job(spark: SparkSession, config: LoadConfig, script: str) -> list[DataFrame]:
    """Publish the target table in this session and run a script text over it."""
    load = loaded(spark, config)
    publish(spark, config, load)
    return _analysed(spark, config, script, load)


def _analysed(spark: SparkSession, config: LoadConfig, script: str, load: Load) -> list[DataFrame]:
    """The results of a script's statements; those of queries are computed here, once, and stored.

    A query that fails fails the job. Column names that a result has twice get a number.
    """
    results = []
    for number, found in enumerate(run_sql_script(spark, script, script_params(config, load))):
        if not found.columns or found.isLocal():  # a command has done its work
            results.append(found)
            continue
        seen: dict[str, int] = {}
        names = []
        for name in found.columns:
            seen[name.lower()] = seen.get(name.lower(), 0) + 1
            names.append(name if seen[name.lower()] == 1 else f"{name}_{seen[name.lower()]}")
        path = f"{config.results_path}/Analytics/{config.table}/{number}"
        overwrite_parquet(found.toDF(*names), path)
        results.append(read_parquet(spark, path))
    return results


def _record(
    spark: SparkSession, results: DataFrame, config: LoadConfig, test_type: str, run_date: Day
) -> DataFrame:
    """Write check results, then roll the written rows up into the ledger.

    The checks run once, in the write; the roll-up reads what was written.
    """
    path = f"{config.results_path}/{test_type}/{config.table}"
    write_results(results, path, config.results_format)
    written = read_results(spark, path, config.results_format)
    append_ledger(status_rollup(written, test_type, run_date), config.ledger_path)
    if config.compact_ledger_after is not None:
        compact_ledger(spark, config.ledger_path, config.compact_ledger_after)
    return written


def unit_test_job(
    spark: SparkSession,
    config: LoadConfig,
    run_date: Day = None,
    checked_at: Timestamp = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """Check the columns of the loaded table against the expected ones and record the outcome.

    ``table`` saves another listing of the target files where the caller has it.
    """
    if table is None:
        table = published_loads(spark, config)[-1].read(spark)
    results = combine_results(
        schema_conformance(table, config.expected_columns, config.table, checked_at),
        column_count_check(table, len(config.expected_columns), config.table, checked_at),
    )
    return _record(spark, results, config, UNIT_TEST, run_date)


def quality_job(
    spark: SparkSession,
    config: LoadConfig,
    previous: DataFrame | int | None = None,
    run_date: Day = None,
    checked_at: Timestamp = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """Check keys and row counts of the loaded table and record the outcome.

    ``previous`` is the table before this load or its row count. Without it, the load is
    compared with the newest earlier one that was checked, as the history of loads has it; a
    first load shows no growth.
    """
    loads = published_loads(spark, config)
    if table is None:
        table = rows_by_key(spark, config, loads[-1])
    if previous is None and (before := baseline(loads)) is not None:
        previous = before.num_rows
    results = quality_checks(
        table,
        config.key_columns,
        config.table,
        threshold=config.threshold_percentage,
        previous=previous,
        minimum=config.minimum_rows,
        checked_at=checked_at,
    )
    written = _record(spark, results, config, DATA_QUALITY, run_date)
    record_check(spark, config.target_path, loads[-1])
    return written


def monitoring_job(spark: SparkSession, config: LoadConfig, run_date: Day = None) -> DataFrame:
    """The alert row over the ledger, for all dates unless one is given."""
    return load_alert(watched_ledger(spark, config, run_date))


def watched_ledger(spark: SparkSession, config: LoadConfig, run_date: Day = None) -> DataFrame:
    """The ledger, of one day if one is given, with a row for each status that the table lacks there."""
    expected = [(config.table, UNIT_TEST), (config.table, DATA_QUALITY)]
    return with_missing(read_ledger(spark, config.ledger_path), expected, run_date)


def daily_run(
    spark: SparkSession,
    config: LoadConfig,
    run_date: Day = None,
    load_ts: Timestamp = None,
) -> DailyRun:
    """Load, analytics, unit tests, quality checks and monitoring, in this order.

    Each step that is done is recorded. A run of the same day and settings that broke off is taken
    up where it did: its load is not written again, nor are steps that were recorded done again. After
    a run that came to its end, the next one is a new one.
    """
    today = run_date if run_date is not None else spark.sql("select current_date()").first()[0]
    journal = steps.Journal(spark, config, today)
    load = _load_of(spark, config, journal.done(steps.LOAD))
    if load is None:
        logger.info("loading %s.%s", config.database, config.table)
        load = write_load(spark, config, load_ts)
        journal.record(steps.LOAD, load_id=load.load_id)
    else:
        logger.info("going on with load %s of %s.%s", load.load_id, config.database, config.table)
    table = publish(spark, config, load)

    analytics: list[DataFrame] = []
    if config.analytics_script is not None:
        script = script_text(spark, config.analytics_script)
        analytics = _analysed(spark, config, script, load)

    logger.info("checking %s", config.target_path)
    keyed = table if load.buckets is None else rows_by_key(spark, config, load)
    outcomes = []
    for step, test_type, job in (
        (steps.UNIT_TESTS, UNIT_TEST, lambda: unit_test_job(spark, config, run_date, load_ts, table)),
        (steps.QUALITY, DATA_QUALITY, lambda: quality_job(spark, config, None, run_date, load_ts, keyed)),
    ):
        if journal.done(step) is None:
            outcomes.append(job())
            journal.record(step, load_id=load.load_id)
        else:
            path = f"{config.results_path}/{test_type}/{config.table}"
            outcomes.append(read_results(spark, path, config.results_format))

    ledger = read_ledger(spark, config.ledger_path)
    alert = load_alert(watched_ledger(spark, config, today))
    remove_old_loads(spark, config)
    journal.record(steps.END)
    logger.info("recorded the run in %s", config.ledger_path)
    return DailyRun(table, analytics, *outcomes, ledger, alert)


def _load_of(spark: SparkSession, config: LoadConfig, recorded: dict | None) -> Load | None:
    """The load that a journal names, if it still is the newest one; None where it has to be made."""
    loads = read_loads(spark, config.target_path) if recorded is not None else []
    return loads[-1] if loads and loads[-1].load_id == recorded["load_id"] else None
