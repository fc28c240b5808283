from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadwarden.names import qualified_name


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(qualified_name(database, table))


def describe_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """``DESCRIBE FORMATTED``: columns first, then the table's location, type and statistics."""
    return spark.sql(f"DESCRIBE FORMATTED {qualified_name(database, table)}")
