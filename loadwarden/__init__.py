"""Daily table loads on Spark with checks, a status ledger and an alert."""

from loadwarden.config import LoadConfig, read_settings
from loadwarden.plans import DailyRun, daily_run, load_pipeline, run_sql_script
from loadwarden.session import build_session
from loadwarden.sources import Source

__all__ = [
    "DailyRun",
    "LoadConfig",
    "Source",
    "build_session",
    "daily_run",
    "load_pipeline",
    "read_settings",
    "run_sql_script",
]
