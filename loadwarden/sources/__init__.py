"""Table scans: files, catalog tables and the status ledger."""

from loadwarden.sources.files import Source, read_csv, read_parquet, read_source
from loadwarden.sources.ledger import LEDGER_SCHEMA, compact_ledger, read_ledger, read_ledger_csv
from loadwarden.sources.results import read_results
from loadwarden.sources.tables import describe_table, read_table

__all__ = [
    "LEDGER_SCHEMA",
    "Source",
    "compact_ledger",
    "describe_table",
    "read_csv",
    "read_ledger",
    "read_ledger_csv",
    "read_parquet",
    "read_results",
    "read_source",
    "read_table",
]
