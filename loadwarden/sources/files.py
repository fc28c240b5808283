from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadwarden.operators.columns import rename_columns


@dataclass(frozen=True)
class Source:
    """One input table: where it lies, how to read it and which columns to rename.

    With ``most_rejected``, a load takes a CSV table in by one pass and sets up to that many records
    aside that do not fit; without it, one that does not fit ends the load.
    """

    path: str
    format: str = "csv"
    schema: StructType | str | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    most_rejected: int | None = None

    def __post_init__(self) -> None:
        if self.most_rejected is not None and self.format != "csv":
            raise ValueError(f"records are set aside from CSV tables only, not from {self.format!r}")


# What is no value stays told from an empty one; with Spark's own null value both are NULL.
CSV_FIDELITY = {"nullValue": "\u0000", "escape": '"'}
_CSV_STRICT = {"enforceSchema": False, "mode": "FAILFAST"}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """A CSV table with a header line.

    Without ``schema`` the types are inferred, which reads the whole input once
    more before the query starts: give one for large inputs. With one, a header that
    does not have its columns in its order and a value that is not of its type are errors.
    A field with nothing in it is NULL, a quoted empty one is an empty text, and a quote
    in a quoted field is doubled. ``options`` win over all of that.
    """
    settings = {**CSV_FIDELITY, **options}
    if schema is None:
        return spark.read.options(header=True, **settings).csv(path, inferSchema=True)
    settings = {**_CSV_STRICT, **settings}
    return spark.read.options(header=True, **settings).csv(path, schema=schema)


def read_headed_csv(
    spark: SparkSession, path: str, headings: Mapping[str, str], schema: StructType
) -> DataFrame:
    """The columns of ``schema`` from a CSV table that has them under other headings.

    A field with nothing in it is NULL, a quoted empty one is an empty text; with
    Spark's own null value both would be NULL.
    """
    stored = spark.read.options(header=True, **CSV_FIDELITY).csv(path)
    return stored.select(
        *(
            F.col(f"`{headings[column.name]}`").cast(column.dataType).alias(column.name)
            for column in schema
        )
    )


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """A Parquet table. ``mergeSchema=True`` reads the schema of every file, not of one."""
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


_READERS = {"csv": read_csv, "parquet": read_parquet}


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """The columns of a configured source under their new names."""
    try:
        reader = _READERS[source.format]
    except KeyError:
        raise ValueError(f"unknown source format {source.format!r}") from None
    return rename_columns(reader(spark, source.path, source.schema, **source.options), source.rename)
