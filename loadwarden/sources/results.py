from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadwarden.labels import RESULT_HEADINGS
from loadwarden.operators.checks import RESULT_SCHEMA
from loadwarden.sources.files import read_headed_csv, read_parquet


def read_results(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A check log as ``write_results`` leaves it."""
    if format == "parquet":
        return read_parquet(spark, path, RESULT_SCHEMA)
    if format == "csv":
        return read_headed_csv(spark, path, RESULT_HEADINGS, RESULT_SCHEMA)
    raise ValueError(f"unknown format {format!r}")
