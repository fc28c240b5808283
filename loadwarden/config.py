"""What a load reads, where it publishes and what its table has to fulfil."""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from loadwarden.labels import DEFAULT_BATCH_ID
from loadwarden.sources.files import Source


@dataclass(frozen=True)
class LoadConfig:
    left: Source
    right: Source
    join_on: Sequence[str]
    database: str
    table: str
    target_path: str
    results_path: str
    ledger_path: str
    key_columns: Sequence[str]
    expected_columns: Sequence[tuple[str, str]]
    threshold_percentage: float = 10
    minimum_rows: int | None = None
    batch_id: str = DEFAULT_BATCH_ID
    partition_by: Sequence[str] = ()
    max_records_per_file: int | None = None
    ddl_script: str | None = None
    analytics_script: str | None = None
    results_format: str = "parquet"
    #: Loads whose files are kept; None keeps all of them.
    keep_loads: int | None = None
    #: Joined rows from which a key is dealt to several tasks; None leaves hot keys to adaptive execution.
    hot_key_rows: int | None = None
    #: Appends to the ledger after which they are put into a snapshot; None leaves all of them as files.
    compact_ledger_after: int | None = None
    #: Columns by whose hash the rows are dealt to ``num_buckets`` buckets, for work by these keys without a shuffle.
    bucket_by: Sequence[str] = ()
    num_buckets: int | None = None

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any], **overrides: Any) -> LoadConfig:
        """From the settings of a config file; ``overrides`` replace fields of the result.

        Fixed values: the settings read by ``[]`` and the two scripts have the names
        and nesting of existing config files. What those files do not tell has
        settings of its own: ``join_on``, the fields of each ``Source`` with the
        prefix ``left_`` or ``right_``, and the optional fields of this class.
        """
        database = settings["database"]
        sources = settings["input_path"]
        monitoring = settings["monitoring_path"]

        def script(setting: str) -> str | None:
            name = database.get(setting)
            return None if name is None else f"{settings['code_path']}/{name}"

        def source(file: str, side: str) -> Source:
            values = {"path": f"{sources}/{settings[file]}"}
            for field in fields(Source):
                if f"{side}_{field.name}" in settings:
                    values[field.name] = settings[f"{side}_{field.name}"]
            return Source(**values)

        values = {
            "left": source("source_file1", "left"),
            "right": source("source_file2", "right"),
            "join_on": settings.get("join_on"),
            "database": database["db_name"],
            "table": database["table_name"],
            "target_path": f"{settings['output_path']}/{database['table_name']}",
            "results_path": monitoring,
            "ledger_path": f"{monitoring}/{settings['load_status_table']}",
            "key_columns": settings["primary_key_columns"],
            "expected_columns": [(c["name"], c["type"]) for c in settings["columns"]],
            "threshold_percentage": settings["threshold_percentage"],
            "ddl_script": script("ddl_script"),
            "analytics_script": script("analytics_script"),
        }
        values.update({name: settings[name] for name in _OPTIONAL if name in settings})
        values.update(overrides)
        if not values["join_on"]:
            raise ValueError("join_on names no column")
        return cls(**values)

    def __post_init__(self) -> None:
        for name in ("join_on", "key_columns", "expected_columns", "partition_by", "bucket_by"):
            value = getattr(self, name)
            if isinstance(value, str):
                raise ValueError(f"{name} is a list, not the text {value!r}")
            object.__setattr__(self, name, tuple(value))
        for side in (self.left, self.right):
            if _overlap(self.target_path, side.path):
                raise ValueError(f"the target {self.target_path} and the source {side.path} overlap")
        if self.keep_loads is not None and self.keep_loads < 1:
            raise ValueError("keep_loads is 1 at least")
        if self.hot_key_rows is not None and self.hot_key_rows < 1:
            raise ValueError("hot_key_rows is 1 at least")
        if bool(self.bucket_by) != (self.num_buckets is not None) or self.num_buckets is not None and self.num_buckets < 1:
            raise ValueError("bucket_by names columns and num_buckets is 1 at least, or neither is given")
        if self.bucket_by and self.partition_by:
            raise ValueError("a table has partition_by or bucket_by, not both")
        if self.compact_ledger_after is not None and self.compact_ledger_after < 1:
            raise ValueError("compact_ledger_after is 1 at least")


# Fields with a default that a config file may set.
_OPTIONAL = (
    "minimum_rows",
    "batch_id",
    "partition_by",
    "max_records_per_file",
    "results_format",
    "keep_loads",
    "hot_key_rows",
    "compact_ledger_after",
    "bucket_by",
    "num_buckets",
)


def _overlap(a: str, b: str) -> bool:
    """Whether one path is or lies in the other one, whatever their scheme."""
    a, b = (
        posixpath.normpath(re.sub(r"^\w+:/*", "/", path) if ":/" in path else path).rstrip("/") + "/"
        for path in (a, b)
    )
    return a.startswith(b) or b.startswith(a)


def read_settings(path: str) -> dict[str, Any]:
    """The settings in a JSON file, or in a YAML file where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError(f"no YAML reader is installed for {path}; give JSON") from error
    return yaml.safe_load(text)
