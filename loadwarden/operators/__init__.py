"""DataFrame to DataFrame operators."""

from loadwarden.operators.checks import (
    RESULT_SCHEMA,
    column_count_check,
    combine_results,
    manifest_checks,
    primary_key_check,
    quality_checks,
    row_count_drift,
    row_count_floor,
    schema_conformance,
)
from loadwarden.operators.columns import add_audit_columns, rename_columns
from loadwarden.operators.counts import (
    distinct_key_count,
    duplicate_keys,
    group_count,
    key_counts,
    row_count,
)
from loadwarden.operators.joins import hot_keys, inner_join_hot, inner_join_using
from loadwarden.operators.schemas import nested_conformance, schema_differences
from loadwarden.operators.status import (
    failing_rows,
    load_alert,
    merge_ledger,
    status_gate,
    status_rollup,
    with_missing,
)

__all__ = [
    "RESULT_SCHEMA",
    "add_audit_columns",
    "column_count_check",
    "combine_results",
    "distinct_key_count",
    "duplicate_keys",
    "failing_rows",
    "group_count",
    "hot_keys",
    "inner_join_hot",
    "inner_join_using",
    "key_counts",
    "load_alert",
    "manifest_checks",
    "merge_ledger",
    "nested_conformance",
    "primary_key_check",
    "quality_checks",
    "rename_columns",
    "row_count",
    "row_count_drift",
    "row_count_floor",
    "schema_conformance",
    "schema_differences",
    "status_gate",
    "status_rollup",
    "with_missing",
]
