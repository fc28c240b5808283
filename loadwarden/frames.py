"""Frames of a few rows that need no task per core."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = (F.lit(None).cast(column.dataType).alias(column.name) for column in schema)
    return spark.range(0, 1, 1, 1).select(*columns).limit(0)


def small_frame(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: StructType
) -> DataFrame:
    """Rows known to the driver; they must be few, such as one per column of a table.

    They are one JSON literal in a one-row frame. A local collection would become
    a task per core and pass through Python workers.
    """
    parsed = F.from_json(F.lit(json.dumps(list(rows))), ArrayType(schema))
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))
