from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadwarden.commits import file_system, names_in
from loadwarden.config import LoadConfig
from loadwarden.history import Load, loads_path, new_load_id, read_loads, record_load, record_publishing
from loadwarden.intake import REJECTED, REJECTED_SCHEMA, ROWS, take_in_csv
from loadwarden.manifest import bucket_rows, manifest_path, read_manifest, write_manifest
from loadwarden.operators import add_audit_columns, inner_join_hot, inner_join_using, rename_columns
from loadwarden.plans.script import run_sql_script
from loadwarden.sinks import Buckets, overwrite_buckets, overwrite_parquet, publish_table, table_shows
from loadwarden.sources import Source, read_source, read_table

LEFT, RIGHT = "left", "right"

#: How many times the mean a bucket's rows may be for work by bucket.
HOT_BUCKET = 2


def loaded(spark: SparkSession, config: LoadConfig) -> Load:
    """The newest load of the target table, published or not."""
    loads = read_loads(spark, config.target_path)
    if not loads:
        raise ValueError(f"no load of {config.target_path} was completed")
    return loads[-1]


def published_loads(spark: SparkSession, config: LoadConfig) -> list[Load]:
    """The loads that were published, the oldest first: the last one is what the table shows."""
    loads = [load for load in read_loads(spark, config.target_path) if load.published]
    if not loads:
        raise ValueError(f"no load of {config.target_path} was completed")
    return loads


def published_rows(spark: SparkSession, config: LoadConfig) -> int | None:
    """Rows of the newest published load; None if there never was one."""
    loads = [load for load in read_loads(spark, config.target_path) if load.published]
    return loads[-1].num_rows if loads else None


def load_manifest(spark: SparkSession, config: LoadConfig, load: Load | None = None) -> DataFrame:
    """The files of a load, by default the newest published one, with their rows, bytes and key ranges."""
    load = published_loads(spark, config)[-1] if load is None else load
    return read_manifest(spark, manifest_path(loads_path(config.target_path), load.load_id))


def publish(spark: SparkSession, config: LoadConfig, load: Load | None = None) -> DataFrame:
    """A load, by default the newest one, as the configured catalog table.

    A configured DDL script is run after that, for what else it defines. Only then the load counts
    as published: one whose script fails is not what later checks look at.
    """
    load = loaded(spark, config) if load is None else load
    publish_table(
        spark, config.database, config.table, load.folder, load.columns, config.partition_by, load.buckets
    )
    if config.ddl_script is not None:
        run_sql_script(spark, script_text(spark, config.ddl_script), script_params(config, load))
    if not load.published:
        record_publishing(spark, config.target_path, load)
    return read_table(spark, config.database, config.table)


def rows_by_key(spark: SparkSession, config: LoadConfig, load: Load) -> DataFrame:
    """The rows of a load for counts and joins by its keys.

    Where they lie in buckets, and the table shows them, it is the table: grouping or joining by the keys then needs
    no shuffle. A bucket is one task's work there, so with one of over ``HOT_BUCKET`` times the mean, which a hot
    key makes, it is the plain files, whose groups are counted before a shuffle.
    """
    if load.buckets is None or not table_shows(spark, config.database, config.table, load.folder):
        return load.read(spark)
    largest = bucket_rows(load_manifest(spark, config, load)).agg(F.max("num_rows")).first()[0] or 0
    if largest * load.buckets.number > HOT_BUCKET * load.num_rows:
        return load.read(spark)
    return read_table(spark, config.database, config.table)


def script_text(spark: SparkSession, path: str) -> str:
    """A script file's text, from any file system the session can read."""
    return spark.read.text(path, wholetext=True).first()["value"]


def script_params(config: LoadConfig, load: Load) -> dict[str, str]:
    return {
        "db_name": config.database,
        "table_name": config.table,
        "parquet_path": load.folder,
    }


def _adopt(spark: SparkSession, config: LoadConfig) -> None:
    """Take a table that lies at the target itself, from before there was a history, into it."""
    if read_loads(spark, config.target_path):
        return
    try:
        table = spark.read.parquet(config.target_path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return
    path = manifest_path(loads_path(config.target_path), "0-before")
    rows = write_manifest(table, config.key_columns, path)
    load = Load("0-before", rows, config.target_path, table.schema, True)
    record_load(spark, config.target_path, load)
    record_publishing(spark, config.target_path, load)


def load_pipeline(
    spark: SparkSession, config: LoadConfig, load_ts: dt.datetime | str | None = None
) -> DataFrame:
    """Join the two sources, stamp the rows, write them as a new load and publish it.

    Each load has a folder of its own beside the target path. The table is pointed to it only
    after all of it was written, so a load that fails leaves the former one as it is.
    """
    load = write_load(spark, config, load_ts)
    table = publish(spark, config, load)
    remove_old_loads(spark, config)
    return table


def write_load(spark: SparkSession, config: LoadConfig, load_ts: dt.datetime | str | None = None) -> Load:
    """Join, stamp and write a new load, with its manifest; it is recorded, but not published.

    Rows are counted in the files that were written: a count in the tasks would count rows twice
    that a lost executor's tasks wrote again.
    """
    _adopt(spark, config)
    load_id = new_load_id()
    left, right = (
        _taken_in(spark, source, f"{_intake_path(config, load_id)}/{side}")
        for source, side in ((config.left, LEFT), (config.right, RIGHT))
    )
    if config.hot_key_rows is None:
        joined = inner_join_using(left, right, config.join_on)
    else:
        joined = inner_join_hot(left, right, config.join_on, cell_rows=config.hot_key_rows)
    stamped = add_audit_columns(joined, config.batch_id, load_ts)
    folder = f"{loads_path(config.target_path)}/{load_id}"
    buckets = Buckets(config.bucket_by, config.num_buckets) if config.num_buckets is not None else None
    if buckets is None:
        overwrite_parquet(stamped, folder, config.partition_by, config.max_records_per_file)
    else:
        overwrite_buckets(stamped, folder, buckets, config.database, config.max_records_per_file)
    load = Load(load_id, 0, folder, stamped.schema, False, False, buckets)
    path = manifest_path(loads_path(config.target_path), load_id)
    files = spark.read.schema(load.columns).parquet(folder)
    load = dataclasses.replace(load, num_rows=write_manifest(files, config.key_columns, path))
    record_load(spark, config.target_path, load)
    for side in (LEFT, RIGHT):
        # The rows are in the load now; what was rejected stays.
        _remove(spark, f"{_intake_path(config, load_id)}/{side}/kind={ROWS}")
    return load


def _intake_path(config: LoadConfig, load_id: str) -> str:
    return f"{loads_path(config.target_path)}/intake/{load_id}"


def _taken_in(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """The rows of a source under their new names, taken in by one pass where records may be set aside."""
    if source.most_rejected is None:
        return read_source(spark, source)
    intake = take_in_csv(
        spark, source.path, folder, source.schema, most_rejected=source.most_rejected, **source.options
    )
    return rename_columns(intake.rows, source.rename)


def rejected_records(spark: SparkSession, config: LoadConfig, load: Load | None = None) -> DataFrame:
    """What a load, by default the newest one, set aside: side, file, text and reason.

    A load that took nothing in by way of setting records aside has none.
    """
    load = loaded(spark, config) if load is None else load
    found = spark.createDataFrame([], StructType([StructField("side", StringType()), *REJECTED_SCHEMA.fields]))
    for side in (LEFT, RIGHT):
        folder = f"{_intake_path(config, load.load_id)}/{side}"
        if f"kind={REJECTED}" in names_in(spark, folder):
            stored = spark.read.schema(REJECTED_SCHEMA).parquet(f"{folder}/kind={REJECTED}")
            found = found.unionByName(stored.withColumn("side", F.lit(side)))
    return found


def _remove(spark: SparkSession, path: str) -> None:
    system, folder = file_system(spark, path)
    system.delete(folder, True)


def remove_old_loads(spark: SparkSession, config: LoadConfig) -> None:
    """Remove the files of all but the newest ``keep_loads`` loads; the history keeps its rows."""
    if config.keep_loads is None:
        return
    for load in read_loads(spark, config.target_path)[: -config.keep_loads]:
        if load.folder.startswith(loads_path(config.target_path)):
            _remove(spark, load.folder)
            _remove(spark, _intake_path(config, load.load_id))
