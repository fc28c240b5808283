"""Where tables, check results and statuses are written."""

from loadwarden.sinks.catalog import publish_table, table_shows
from loadwarden.sinks.files import Buckets, overwrite_buckets, overwrite_csv, overwrite_parquet
from loadwarden.sinks.status import append_ledger, write_ledger_csv, write_results

__all__ = [
    "Buckets",
    "append_ledger",
    "overwrite_buckets",
    "overwrite_csv",
    "overwrite_parquet",
    "publish_table",
    "table_shows",
    "write_ledger_csv",
    "write_results",
]
