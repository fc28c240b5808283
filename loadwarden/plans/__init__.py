"""Jobs composed of sources, operators and sinks."""

from loadwarden.plans.jobs import (
    DailyRun,
    analytics_job,
    daily_run,
    monitoring_job,
    quality_job,
    unit_test_job,
    watched_ledger,
)
from loadwarden.plans.load import (
    load_manifest,
    load_pipeline,
    publish,
    published_rows,
    rejected_records,
    rows_by_key,
    write_load,
)
from loadwarden.plans.script import run_sql_script, script_statements, show_results

__all__ = [
    "DailyRun",
    "analytics_job",
    "daily_run",
    "load_manifest",
    "load_pipeline",
    "publish",
    "monitoring_job",
    "published_rows",
    "quality_job",
    "rejected_records",
    "rows_by_key",
    "run_sql_script",
    "script_statements",
    "show_results",
    "unit_test_job",
    "watched_ledger",
    "write_load",
]
