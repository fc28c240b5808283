"""The jobs as commands: ``spark-submit`` this file or run ``python -m loadwarden``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from loadwarden.config import LoadConfig, read_settings
from loadwarden.operators import failing_rows
from loadwarden.plans import (
    analytics_job,
    daily_run,
    load_pipeline,
    monitoring_job,
    quality_job,
    show_results,
    unit_test_job,
    watched_ledger,
)
from loadwarden.plans.load import script_text
from loadwarden.session import build_session


def _load(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    load_pipeline(spark, config)
    return False


def _analytics(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    if config.analytics_script is None:
        raise ValueError("the config names no analytics_script")
    results = analytics_job(spark, config, script_text(spark, config.analytics_script))
    show_results(results, args.rows)
    return False


def _unit_test(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    show_results([unit_test_job(spark, config, args.run_date)])
    return False


def _quality(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    show_results([quality_job(spark, config, args.previous_rows, args.run_date)])
    return False


def _monitor(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    alert = monitoring_job(spark, config, args.run_date)
    show_results([alert, failing_rows(watched_ledger(spark, config, args.run_date))])
    return alert.first()["any_fail"]


def _daily(spark: SparkSession, config: LoadConfig, args: argparse.Namespace) -> bool:
    run = daily_run(spark, config, args.run_date)
    show_results(run.analytics, args.rows)
    show_results([run.unit_tests, run.quality, run.ledger, run.alert])
    return run.alert.first()["any_fail"]


_JOBS = {
    "load": _load,
    "analytics": _analytics,
    "unit-test": _unit_test,
    "quality": _quality,
    "monitor": _monitor,
    "daily": _daily,
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loadwarden", description=__doc__)
    parser.add_argument("job", choices=_JOBS)
    parser.add_argument("--config", required=True, help="JSON or YAML settings file")
    parser.add_argument("--run-date", help="YYYY-MM-DD; today, or all dates for monitor")
    parser.add_argument("--previous-rows", type=int, help="rows before this load, for quality")
    parser.add_argument("--rows", type=int, default=50, help="rows shown of each analytics result")
    parser.add_argument("--input-bytes", type=int, help="size of the sources, to size the session")
    parser.add_argument("--fail-on-alert", action="store_true", help="exit with 2 on an alert")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(levelname)s - %(message)s")
    config = LoadConfig.from_mapping(read_settings(args.config))
    spark = build_session(f"loadwarden {args.job}", input_bytes=args.input_bytes)
    alerted = _JOBS[args.job](spark, config, args)
    return 2 if alerted and args.fail_on_alert else 0


if __name__ == "__main__":
    sys.exit(main())
