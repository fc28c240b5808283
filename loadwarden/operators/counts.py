"""Row, group and key counts. Each is one scan; groups are pre-aggregated before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "num_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, by: Sequence[str], name: str = "num_rows") -> DataFrame:
    """Rows per group; NULL is a group of its own."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def distinct_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of distinct keys. NULL counts as a value, unlike in ``count_distinct``."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("num_distinct_rows"))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows in one row, from one scan and one shuffle of the keys."""
    return (
        group_count(df, keys, "n")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
            F.count(F.lit(1)).alias("num_distinct_rows"),
        )
        .withColumn("num_duplicates", F.col("num_rows") - F.col("num_distinct_rows"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return group_count(df, keys, "num_rows").where(F.col("num_rows") > 1)
