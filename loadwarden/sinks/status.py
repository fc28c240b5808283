from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwarden.commits import file_system, names_in
from loadwarden.labels import LEDGER_HEADINGS, RESULT_HEADINGS
from loadwarden.sinks.files import overwrite_csv, overwrite_parquet
from loadwarden.sources.ledger import STAGED, LEDGER_SCHEMA, commit_ledger, read_ledger, settle_ledger, stored_ledger


def _with_headings(df: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    """All columns as text, times in the session time zone and without offset."""
    return df.select(
        *(F.col(name).cast("string").alias(heading) for name, heading in headings.items())
    )


def write_results(results: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace the check log at ``path``; as CSV it has the headings of ``RESULT_HEADINGS``."""
    if format == "parquet":
        overwrite_parquet(results, path)
    elif format == "csv":
        overwrite_csv(_with_headings(results, RESULT_HEADINGS), path)
    else:
        raise ValueError(f"unknown format {format!r}")


def append_ledger(new: DataFrame, path: str) -> DataFrame:
    """Add the rows that the ledger does not hold yet and return the ledger.

    Appending the same rows again changes nothing. Rows are written aside, where no reader
    sees them, and committed by a numbered file that only one writer can create; another one that
    wanted the number reads the ledger anew and keeps what is still unseen. So two writers
    store a row once, and one that is killed before its commit leaves nothing to be read. Stored
    files are never rewritten. Partitions by date let a query for one day read that day only.
    """
    spark = new.sparkSession
    rows = new.select(*LEDGER_SCHEMA.names)
    while True:
        number = settle_ledger(spark, path)
        staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
        rows.subtract(stored_ledger(spark, path)).write.partitionBy("date").parquet(staged)
        files = [f"{day}/{name}" for day in names_in(spark, staged) if "=" in day for name in names_in(spark, f"{staged}/{day}")]
        if files and not commit_ledger(spark, path, number, staged.rsplit("/", 1)[1], files):
            _delete(spark, staged)
            continue
        if files:
            settle_ledger(spark, path)
        _delete(spark, staged)
        return read_ledger(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    system, hadoop = file_system(spark, folder)
    system.delete(hadoop, True)


def write_ledger_csv(ledger: DataFrame, path: str) -> None:
    """Replace the CSV copy of the ledger, with the headings of ``LEDGER_HEADINGS``."""
    overwrite_csv(_with_headings(ledger, LEDGER_HEADINGS), path)
