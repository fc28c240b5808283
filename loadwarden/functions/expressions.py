from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change(current: Column, previous: Column) -> Column:
    """Growth from ``previous`` to ``current`` in percent; NULL when ``previous`` is 0."""
    return F.try_divide(current - previous, previous) * F.lit(100)


def plain_number(value: Column) -> Column:
    """A double as text without exponent, with its shortest digits and at least one decimal.

    Casting it to text would give 1.0E7 from ten millions on. Exact from 0.001 to 1e16.
    """
    padded = value.cast("decimal(38, 17)").cast("string")
    return F.regexp_replace(padded, r"(\.\d+?)0+$", "$1")


def _checked_time(moment: dt.datetime | str) -> str:
    """A time as text; one that is no time is an error, where a cast might give NULL."""
    return str(dt.datetime.fromisoformat(moment) if isinstance(moment, str) else moment)


def load_stamp(load_ts: dt.datetime | str | None = None) -> Column:
    """The load time as text.

    The current time is one value for the whole query. A given time is taken as
    wall-clock time, whatever the session time zone is; one with an offset is shown
    in the session time zone.
    """
    if load_ts is None:
        return F.current_timestamp().cast("string")
    moment = _checked_time(load_ts)
    has_offset = dt.datetime.fromisoformat(moment).tzinfo is not None
    return F.lit(moment).cast("timestamp" if has_offset else "timestamp_ntz").cast("string")


def check_time(checked_at: dt.datetime | str | None = None) -> Column:
    """The time of a check, now unless given; without an offset it is in the session time zone."""
    if checked_at is None:
        return F.current_timestamp()
    return F.lit(_checked_time(checked_at)).cast("timestamp")


def run_day(run_date: dt.date | str | None = None) -> Column:
    """The date of a run, today unless given."""
    if run_date is None:
        return F.current_date()
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    if isinstance(run_date, dt.datetime):
        run_date = run_date.date()
    return F.lit(run_date)


def text_of(*parts: Column | str | int | float) -> Column:
    """Parts joined to one text; plain values are taken literally."""
    return F.concat(
        *(part.cast("string") if isinstance(part, Column) else F.lit(str(part)) for part in parts)
    )
