"""Texts, names and labels that existing consumers of the results rely on."""

# Statuses.
PASS = "PASS"
FAIL = "FAIL"

# Test types in the status ledger.
UNIT_TEST = "UnitTest"
DATA_QUALITY = "DataQuality"

# Test names in the check results. A column's type test is named "<column> data_type".
DATA_TYPE_TEST_SUFFIX = " data_type"
PRIMARY_KEY_TEST = "test_primary_key"
COUNT_INCREASE_TEST = "test_count_increase"
COLUMN_COUNT_TEST = "test_column_count"
COUNT_FLOOR_TEST = "test_count_floor"

# Reasons of the type, key and growth tests.
EXPECTED_TYPE = "Expected Datatype"
UNEXPECTED_TYPE = "Expected {expected}, but got {actual}"
DUPLICATE_KEYS = ("Total of ", " duplicate primary key values found")
INCREASE_BELOW = "Count increase percentage  is below threshold ({threshold}%)"
INCREASE_ABOVE = ("Count increase percentage (", "%) is more than threshold ({threshold}%)")

# Messages of the load alert.
ALERT_FAILED = (
    "Please check Data Quality log for detailed failures. "
    "Please find the attached table log for details."
)
# A status that ought to be there and is not.
MISSING = "MISSING"
ALERT_MISSING = "A status that was expected is missing in the ledger."
ALERT_PASSED = "Data Quality Job completed successfully without failures."

# Batch id of a load that names none.
DEFAULT_BATCH_ID = "101"

# Column headings of the CSV form of check results and ledger, in file order.
RESULT_HEADINGS = {
    "table_name": "Table Name",
    "test_name": "Test Name",
    "status": "Status",
    "reason": "Reason",
    "checked_at": "Timestamp",
}
LEDGER_HEADINGS = {
    "table_name": "Table Name",
    "status": "Status",
    "test_type": "Test Type",
    "date": "Date",
}
