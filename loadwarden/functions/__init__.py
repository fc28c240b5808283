"""Column expressions shared by the operators."""

from loadwarden.functions.expressions import (
    check_time,
    load_stamp,
    percent_change,
    plain_number,
    run_day,
    text_of,
)

__all__ = ["check_time", "load_stamp", "percent_change", "plain_number", "run_day", "text_of"]
