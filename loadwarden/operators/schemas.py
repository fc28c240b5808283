"""Comparison of nested schemas, path by path. It reads metadata only."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from loadwarden.frames import small_frame
from loadwarden.labels import DATA_TYPE_TEST_SUFFIX, EXPECTED_TYPE, UNEXPECTED_TYPE
from loadwarden.operators.checks import Timestamp, known_results

MISSING, EXTRA, OTHER_TYPE, NULLABLE = "missing", "extra", "type", "nullable"

DIFFERENCE_SCHEMA = StructType(
    [StructField(name, StringType()) for name in ("path", "difference", "expected", "actual")]
)

Difference = tuple[str, str, str | None, str | None]


def schema_differences(df: DataFrame, expected: StructType | str, *, nullability: bool = False) -> DataFrame:
    """One row per path that differs: ``path``, ``difference``, ``expected`` and ``actual`` type.

    Fields of structs are compared by name, with case, whatever their order; elements of arrays lie at ``[]``, keys and
    values of maps at ``{key}`` and ``{value}``; names that are no plain words are quoted. What is missing
    or extra is one row, with all that lies in it. With ``nullability``, a path that may
    hold NULLs where none are expected is a row as well; the reverse is none. The rows come in the order
    of the expected fields, each struct's extra ones after its others.
    """
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    found = _differences("", wanted, df.schema, nullability)
    rows = [dict(zip(DIFFERENCE_SCHEMA.names, difference)) for difference in found]
    return small_frame(df.sparkSession, rows, DIFFERENCE_SCHEMA)


def nested_conformance(
    df: DataFrame,
    expected: StructType | str,
    table_name: str,
    checked_at: Timestamp = None,
    *,
    nullability: bool = False,
) -> DataFrame:
    """Check rows of the comparison: a FAIL for each path that differs and a PASS for each column that does not."""
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    columns = StructType(df.schema.fields)
    results = []
    for field in wanted:
        own = StructType([c for c in columns if c.name == field.name])
        found = list(_differences("", StructType([field]), own, nullability))
        results += [(path + DATA_TYPE_TEST_SUFFIX, False, _reason(*rest)) for path, *rest in found]
        if not found:
            results.append((_step("", field.name) + DATA_TYPE_TEST_SUFFIX, True, EXPECTED_TYPE))
    known = set(wanted.names)
    extra = [c for c in columns if c.name not in known]
    results += [
        (_step("", c.name) + DATA_TYPE_TEST_SUFFIX, False, _reason(EXTRA, None, c.dataType.simpleString())) for c in extra
    ]
    return known_results(df, table_name, results, checked_at)


def _reason(difference: str, expected: str | None, actual: str | None) -> str:
    if difference == MISSING:
        return f"Expected {expected}, but it is missing"
    if difference == EXTRA:
        return f"Expected nothing, but got {actual}"
    if difference == NULLABLE:
        return f"Expected {expected} without NULLs, but it may hold some"
    return UNEXPECTED_TYPE.format(expected=expected, actual=actual)


def _differences(path: str, expected: DataType, actual: DataType, nullability: bool) -> Iterator[Difference]:
    if isinstance(expected, StructType) and isinstance(actual, StructType):
        there = {field.name: field for field in actual}
        for field in expected:
            step, kind = _step(path, field.name), field.dataType.simpleString()
            if field.name not in there:
                yield step, MISSING, kind, None
                continue
            other = there[field.name]
            yield from _nulls(step, field.dataType, field.nullable, other.nullable, nullability)
            yield from _differences(step, field.dataType, other.dataType, nullability)
        known = set(expected.names)
        for field in actual:
            if field.name not in known:
                yield _step(path, field.name), EXTRA, None, field.dataType.simpleString()
    elif isinstance(expected, ArrayType) and isinstance(actual, ArrayType):
        step = f"{path}[]"
        yield from _nulls(step, expected.elementType, expected.containsNull, actual.containsNull, nullability)
        yield from _differences(step, expected.elementType, actual.elementType, nullability)
    elif isinstance(expected, MapType) and isinstance(actual, MapType):
        yield from _differences(f"{path}{{key}}", expected.keyType, actual.keyType, nullability)
        step = f"{path}{{value}}"
        yield from _nulls(step, expected.valueType, expected.valueContainsNull, actual.valueContainsNull, nullability)
        yield from _differences(step, expected.valueType, actual.valueType, nullability)
    elif expected.simpleString() != actual.simpleString():
        yield path, OTHER_TYPE, expected.simpleString(), actual.simpleString()


def _nulls(path: str, kind: DataType, expected: bool, actual: bool, nullability: bool) -> Iterator[Difference]:
    if nullability and actual and not expected:
        yield path, NULLABLE, kind.simpleString(), kind.simpleString()


def _step(path: str, name: str) -> str:
    quoted = name if re.fullmatch(r"\w+", name) else "`" + name.replace("`", "``") + "`"
    return f"{path}.{quoted}" if path else quoted
