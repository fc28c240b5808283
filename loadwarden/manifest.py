"""What a load consists of: its files, with their rows, bytes and ranges of the keys.

A manifest is taken from the files as they were written, not from a counter in the tasks that wrote
them, which counts twice what a lost executor did. Row counts of a load are sums over a
row per file, without a scan of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

KEY_RANGE = StructType([StructField(name, StringType()) for name in ("key", "least", "most")])
MANIFEST_SCHEMA = StructType(
    [
        StructField("file", StringType()),
        StructField("num_rows", LongType()),
        StructField("num_bytes", LongType()),
        StructField("key_ranges", ArrayType(KEY_RANGE)),
    ]
)


def manifest_of(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A row per file of a table read from files; only ``keys`` are read besides the footers.

    Ranges are texts; a key that the table does not have has none, and that of a file with
    NULLs alone is NULL.
    """
    known = {name.lower() for name in table.columns}
    ranges = [
        F.struct(
            F.lit(key).alias("key"),
            F.min(f"`{key}`").cast("string").alias("least"),
            F.max(f"`{key}`").cast("string").alias("most"),
        )
        for key in keys
        if key.lower() in known
    ]
    empty = F.array().cast(ArrayType(KEY_RANGE))
    return (
        table.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("num_bytes"))
        .agg(F.count(F.lit(1)).alias("num_rows"), (F.array(*ranges) if ranges else empty).alias("key_ranges"))
        .select(*(F.col(f.name).cast(f.dataType) for f in MANIFEST_SCHEMA))
    )


def manifest_path(loads_path: str, load_id: str) -> str:
    return f"{loads_path}/manifests/{load_id}"


def write_manifest(table: DataFrame, keys: Sequence[str], path: str) -> int:
    """Store the manifest of a load's files and return their rows."""
    manifest_of(table, keys).coalesce(1).write.mode("overwrite").parquet(path)
    return manifest_counts(read_manifest(table.sparkSession, path)).first()["num_rows"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """One row: the load's rows, bytes and files."""
    nothing = F.lit(0).cast("long")
    return manifest.agg(
        F.coalesce(F.sum("num_rows"), nothing).alias("num_rows"),
        F.coalesce(F.sum("num_bytes"), nothing).alias("num_bytes"),
        F.count(F.lit(1)).alias("num_files"),
    )


def files_with_key(manifest: DataFrame, key: str, value: str, kind: str) -> DataFrame:
    """The files whose range of ``key``, compared as ``kind``, holds the value."""
    ranges = F.filter("key_ranges", lambda r: r["key"] == key)
    holds = F.exists(ranges, lambda r: F.lit(value).cast(kind).between(r["least"].cast(kind), r["most"].cast(kind)))
    return manifest.where(holds)


def bucket_rows(manifest: DataFrame) -> DataFrame:
    """Rows per bucket of files that Spark wrote by bucket, which have its number in their names."""
    number = F.regexp_extract("file", r"_(\d+)(?:\.[^/]*)?$", 1).cast("int")
    return manifest.groupBy(number.alias("bucket")).agg(F.sum("num_rows").alias("num_rows"))
