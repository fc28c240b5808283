from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import takewhile
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loadwarden.names import checked_identifier, qualified_name
from loadwarden.sinks.files import Buckets

_LIST_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"

# Properties that Spark keeps for itself and takes from no statement.
_OWN_PROPERTIES = ("spark.sql.", "transient_lastDdlTime", "numFiles", "totalSize", "EXTERNAL")


@dataclass(frozen=True)
class _Definition:
    """What the catalog says about a table."""

    kind: str
    location: str
    columns: StructType
    partitions: tuple[str, ...] = ()
    comment: str | None = None
    listed: bool = False  # the catalog keeps a list of the partitions, each with its place
    buckets: Buckets | None = None


def _definition(spark: SparkSession, name: str) -> _Definition:
    described = spark.sql(f"DESCRIBE FORMATTED {name}").collect()
    # The table's own columns come first and may have any name, so the last row wins.
    details = {row["col_name"]: row["data_type"] for row in described}
    names = [row["col_name"] for row in described]
    partitions: list[str] = []
    if "# Partition Information" in names:
        begin = len(names) - names[::-1].index("# Partition Information") + 1
        partitions = list(takewhile(lambda n: n != "", names[begin:]))
    about = {row["col_name"]: row["data_type"] for row in described[names.index("# Detailed Table Information") :]}
    buckets = None
    if "Num Buckets" in about:
        keys = re.findall(r"`((?:[^`]|``)+)`", about["Bucket Columns"])
        buckets = Buckets(tuple(key.replace("``", "`") for key in keys), int(about["Num Buckets"]))
    return _Definition(
        kind=details["Type"],
        location=details["Location"],
        columns=spark.table(name).schema,
        partitions=tuple(partitions),
        comment=details.get("Comment"),
        listed=details.get("Partition Provider") == "Catalog",
        buckets=buckets,
    )


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {
        row["key"]: row["value"]
        for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        if not row["key"].startswith(_OWN_PROPERTIES)
    }


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with the scheme and the host that the session's file systems give it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString().rstrip("/")


def _folders(stored: DataFrame) -> tuple[str, ...]:
    """The partition columns that the folders of the files name."""
    files = stored.inputFiles()
    folders = files[0].split("/")[:-1] if files else []
    named = [unquote(folder.split("=", 1)[0]) for folder in folders if "=" in folder]
    return tuple(name for name in named if name in stored.columns)


def _types(schema: StructType, partitions: Sequence[str]) -> list[tuple[str, str]]:
    """Names and types, the partition columns last, as the catalog has them."""
    found = [(c.name, c.dataType.simpleString()) for c in schema]
    return [c for c in found if c[0] not in partitions] + [
        c for p in partitions for c in found if c[0] == p
    ]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(name: str, kind: str, comments: dict[str, str]) -> str:
    comment = f" COMMENT {_text(comments[name])}" if name in comments else ""
    return f"`{name.replace('`', '``')}` {kind}{comment}"


def _create(
    spark: SparkSession,
    name: str,
    path: str,
    columns: list[tuple[str, str]],
    partitions: Sequence[str],
    former: _Definition | None,
    properties: Mapping[str, str],
    buckets: Buckets | None = None,
) -> None:
    """Define the table; comments and properties of a former definition are carried over.

    The catalog does not list the partitions of a partitioned table, which are found in its
    folder: so the table moves, with all of its partitions, when its location is set.
    """
    comments = {}
    if former is not None:
        comments = {
            c.name: c.metadata["comment"] for c in former.columns if c.metadata.get("comment")
        }
    listed = ", ".join(_column(c, kind, comments) for c, kind in columns)
    parts = [f"CREATE TABLE {name} ({listed}) USING parquet"]
    if partitions:
        parts.append("PARTITIONED BY (" + ", ".join(f"`{p}`" for p in partitions) + ")")
    if buckets is not None:
        keys = ", ".join("`" + key.replace("`", "``") + "`" for key in buckets.keys)
        parts.append(f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets.number} BUCKETS")
    parts.append(f"LOCATION {_text(path)}")
    if former is not None and former.comment:
        parts.append(f"COMMENT {_text(former.comment)}")
    if properties:
        listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({listed})")
    before = spark.conf.get(_LIST_PARTITIONS)
    spark.conf.set(_LIST_PARTITIONS, "false")
    try:
        spark.sql(" ".join(parts))
    finally:
        spark.conf.set(_LIST_PARTITIONS, before)


def publish_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """Make the Parquet table at ``path`` readable as ``database.table``.

    ``schema`` is that of the written rows; without it, it is read from the files, and
    partition columns have the types that their folders' names look like. A
    definition with the same columns is pointed to the path, partitioned or not, in one step of
    the catalog: a reader finds the former rows before it and the new ones after it. Added columns
    are added first. For other changes, as other buckets are, and once for a partitioned table whose partitions the
    catalog lists, it is created anew, with the comments and properties it had.
    Dropping an external table leaves its files; a managed one is never dropped.
    """
    name = qualified_name(database, table)
    if schema is None:
        stored = spark.read.parquet(path)
        schema, partition_by = stored.schema, _folders(stored)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{checked_identifier(database)}`")
    columns = _types(schema, partition_by)
    former = _definition(spark, name) if spark.catalog.tableExists(name) else None
    if former is None:
        _create(spark, name, path, columns, partition_by, None, {}, buckets)
    else:
        _redefine(spark, name, path, columns, tuple(partition_by), former, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_shows(spark: SparkSession, database: str, table: str, path: str) -> bool:
    """Whether the catalog has the table and it lies at ``path``."""
    name = qualified_name(database, table)
    if not spark.catalog.tableExists(name):
        return False
    return qualified_path(spark, _definition(spark, name).location) == qualified_path(spark, path)


def _redefine(
    spark: SparkSession,
    name: str,
    path: str,
    columns: list[tuple[str, str]],
    partitions: tuple[str, ...],
    former: _Definition,
    buckets: Buckets | None,
) -> None:
    known = _types(former.columns, former.partitions)
    moved = qualified_path(spark, former.location) != qualified_path(spark, path)
    same = former.partitions == partitions and not former.listed and former.buckets == buckets
    if known == columns and same and not moved:
        return
    if former.kind != "EXTERNAL":
        raise ValueError(f"{name} is a {former.kind} table, dropping it would drop its data")
    # Partition columns are the last ones, and new ones are added before them.
    data, had = (found[: len(found) - len(partitions)] for found in (columns, known))
    if not same or data[: len(had)] != had or columns[len(data) :] != known[len(had) :]:
        properties = _properties(spark, name)
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, path, columns, partitions, former, properties, buckets)
        return
    if added := data[len(had) :]:
        listed = ", ".join(_column(c, kind, {}) for c, kind in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    if moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
