from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.names import checked_identifier, qualified_name


@dataclass(frozen=True)
class Buckets:
    """Rows dealt by a hash of the keys to a fixed number of buckets, sorted by the keys in each file."""

    keys: tuple[str, ...]
    number: int


def overwrite_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Replace the Parquet table at ``path``, which ``df`` must not read from.

    An unpartitioned table is written as the tasks produce it, with no extra
    shuffle. For a partitioned one the rows are rebalanced on the partition
    columns first, so that a task does not open a file per partition; adaptive
    execution splits a partition that holds most of the rows.
    """
    if partition_by:
        df = _with_named_partitions(df, partition_by).hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def overwrite_buckets(
    df: DataFrame, path: str, buckets: Buckets, database: str, max_records_per_file: int | None = None
) -> None:
    """Replace the Parquet table at ``path``, which ``df`` must not read from, by files of buckets.

    One shuffle by the keys brings a bucket's rows together; adaptive execution splits one that holds
    most of the rows, whose bucket then has several files. Spark writes buckets of catalog tables only, so for
    the time of the write there is a definition of another name in ``database``, over the same files.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{checked_identifier(database)}`")
    name = qualified_name(database, f"loading_{uuid.uuid4().hex}")
    first, *others = buckets.keys
    quoted = ("`" + key.replace("`", "``") + "`" for key in buckets.keys)
    writer = (
        df.hint("rebalance", buckets.number, *quoted)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets.number, first, *others)
        .sortBy(first, *others)
    )
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    try:
        writer.saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _with_named_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df``, failing on an empty text in a partition column: as a folder's name it would be NULL."""
    types = dict(df.dtypes)
    for name in partition_by:
        if types[name] == "string":
            empty = F.raise_error(F.lit(f"an empty text in the partition column {name}"))
            column = F.col(f"`{name}`")
            df = df.withColumn(name, F.when(column == "", empty).otherwise(column))
    return df


# Spark's own formats stop at milliseconds.
_CSV_FORMATS = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


# Blanks at the ends of a value are kept, and a quote in one is doubled.
_CSV_FIDELITY = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
}


def overwrite_csv(df: DataFrame, path: str, multiLine: bool = False, **options: str) -> None:
    """Replace the CSV table at ``path``, with a header line in each file.

    A text with a line break is an error unless ``multiLine`` is given; files with such
    texts have to be read with ``multiLine=True``, a file per task.
    """
    if not multiLine:
        for name, kind in df.dtypes:
            if kind == "string":
                column = F.col(f"`{name}`")
                broken = F.raise_error(F.lit(f"a line break in the column {name}; see multiLine"))
                df = df.withColumn(name, F.when(column.rlike("[\r\n]"), broken).otherwise(column))
    settings = {**_CSV_FORMATS, **_CSV_FIDELITY, **options}
    df.write.options(header=True, **settings).mode("overwrite").csv(path)
