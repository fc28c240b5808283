from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.functions import load_stamp
from loadwarden.labels import DEFAULT_BATCH_ID


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns under new names, in place; a name that is missing is an error."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no column {missing} among {df.columns}")
    return df.withColumnsRenamed(dict(names))


def add_audit_columns(
    df: DataFrame,
    batch_id: str = DEFAULT_BATCH_ID,
    load_ts: dt.datetime | str | None = None,
) -> DataFrame:
    """The load's batch id and time as two text columns at the end."""
    return df.withColumns({"batch_id": F.lit(batch_id), "load_date": load_stamp(load_ts)})
