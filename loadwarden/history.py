"""What was loaded when: a row for each load of a table, and one each for its publishing and its checks."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loadwarden.commits import file_system, names_in
from loadwarden.frames import small_frame
from loadwarden.sinks.files import Buckets

#: ``loaded`` is what a load was recorded as when publishing was not recorded: it counts as published.
LOADED, WRITTEN, PUBLISHED, CHECKED = "loaded", "written", "published", "checked"

#: Files of a history from which a new load puts them into one.
MOST_FILES = 100

HISTORY_SCHEMA = StructType(
    [
        StructField("load_id", StringType()),
        StructField("event", StringType()),
        StructField("num_rows", LongType()),
        StructField("folder", StringType()),
        StructField("columns", StringType()),
        StructField("buckets", StringType()),
    ]
)


@dataclass(frozen=True)
class Load:
    """One load: its rows, where they lie and with which columns; whether it was checked and published."""

    load_id: str
    num_rows: int
    folder: str
    columns: StructType
    checked: bool
    published: bool = True
    buckets: Buckets | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        """The loaded rows, with the types they were written with."""
        return spark.read.schema(self.columns).parquet(self.folder).select(*self.columns.names)


def loads_path(target_path: str) -> str:
    """The folder beside the target that holds each load and the history of them."""
    return f"{target_path.rstrip('/')}-loads"


def new_load_id() -> str:
    """An id that sorts by time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def record_load(spark: SparkSession, target_path: str, load: Load) -> None:
    compact_history(spark, target_path)
    _append(spark, target_path, load.load_id, WRITTEN, load)


def record_publishing(spark: SparkSession, target_path: str, load: Load) -> None:
    _append(spark, target_path, load.load_id, PUBLISHED, load)


def record_check(spark: SparkSession, target_path: str, load: Load) -> None:
    _append(spark, target_path, load.load_id, CHECKED, load)


def _append(spark: SparkSession, target_path: str, load_id: str, event: str, load: Load) -> None:
    row = {
        "load_id": load_id,
        "event": event,
        "num_rows": load.num_rows,
        "folder": load.folder,
        "columns": load.columns.json(),
        "buckets": None if load.buckets is None else json.dumps(dataclasses.asdict(load.buckets)),
    }
    small_frame(spark, [row], HISTORY_SCHEMA).write.mode("append").parquet(
        f"{loads_path(target_path)}/history"
    )


def compact_history(spark: SparkSession, target_path: str, most_files: int = MOST_FILES) -> bool:
    """Put the history's files into one if there are ``most_files`` or more; whether it did.

    The new file appears whole, and only then the ones that it was made of are removed. A reader in between, or after a
    run that was killed there, finds events twice, which counts as once. Two that do it at once remove
    no file whose rows are not in a file that stays.
    """
    path = f"{loads_path(target_path)}/history"
    files = [f"{path}/{name}" for name in names_in(spark, path) if name.endswith(".parquet")]
    if len(files) < most_files:
        return False
    events = spark.read.schema(HISTORY_SCHEMA).parquet(*files).distinct()
    events.coalesce(1).write.mode("append").parquet(path)
    for file in files:
        system, hadoop = file_system(spark, file)
        system.delete(hadoop, False)
    return True


def read_loads(spark: SparkSession, target_path: str) -> list[Load]:
    """All loads that were completed, the oldest first; none if there never was one.

    A history that is there but cannot be read is an error.
    """
    # A few rows per run of the job, so they are put together here.
    rows = _events(spark, f"{loads_path(target_path)}/history")
    events: dict[str, set[str]] = {}
    for row in rows:
        events.setdefault(row["load_id"], set()).add(row["event"])
    first = {row["load_id"]: row for row in rows}
    return [
        Load(
            load_id,
            row["num_rows"],
            row["folder"],
            StructType.fromJson(json.loads(row["columns"])),
            CHECKED in events[load_id],
            bool(events[load_id] & {LOADED, PUBLISHED, CHECKED}),
            _buckets(row["buckets"]),
        )
        for load_id, row in sorted(first.items())
    ]


def _buckets(recorded: str | None) -> Buckets | None:
    if recorded is None:
        return None
    found = json.loads(recorded)
    return Buckets(tuple(found["keys"]), found["number"])


def _events(spark: SparkSession, path: str, tries: int = 3) -> list[Row]:
    """The rows of all files; listed again where some were put into one in the meantime."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    except PySparkException as error:
        if tries == 1 or "FILE_NOT_EXIST" not in str(error):
            raise
    return _events(spark, path, tries - 1)


def baseline(loads: list[Load]) -> Load | None:
    """The load that the newest one is compared with, or None if it is the first.

    That is the newest earlier load whose quality was checked: one that was not, because its
    run broke off or nobody ran the checks, must not become the measure of the next. Where
    none was checked it is the oldest. One that was never published is no measure.
    """
    earlier = [load for load in loads[:-1] if load.published]
    checked = [load for load in earlier if load.checked]
    return checked[-1] if checked else earlier[0] if earlier else None
