"""The steps that a daily run has done, so that one that broke off can be taken up again."""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import json
from typing import Any

from pyspark.sql import SparkSession

from loadwarden.commits import create_once, names_in, read_text
from loadwarden.config import LoadConfig

LOAD, ANALYTICS, UNIT_TESTS, QUALITY, END = "load", "analytics", "unit_tests", "quality", "end"


def config_digest(config: LoadConfig) -> str:
    """A digest of everything that is configured; a run with other settings is another run."""
    return hashlib.sha256(repr(dataclasses.asdict(config)).encode()).hexdigest()[:16]


class Journal:
    """The newest run of a day with these settings.

    Each step is a file that is created once, when the step is done, with what later steps need of
    it. A run with an end is over: the next one begins anew. Two runs of the same day
    and settings at the same time share their steps; a step that both did counts once, as the
    first one recorded it.
    """

    def __init__(self, spark: SparkSession, config: LoadConfig, day: dt.date | str):
        self.spark = spark
        self.folder = f"{config.results_path}/journal/{config.table}/{day}-{config_digest(config)}"
        runs = names_in(spark, self.folder)
        self.run = runs[-1] if runs else "00000"
        if END in self.steps():
            self.run = f"{int(self.run) + 1:05}"

    def steps(self) -> list[str]:
        """The steps that are done."""
        return names_in(self.spark, f"{self.folder}/{self.run}")

    def done(self, step: str) -> dict[str, Any] | None:
        """What the step recorded, or None if it was not done."""
        if step not in self.steps():
            return None
        return json.loads(read_text(self.spark, f"{self.folder}/{self.run}/{step}"))

    def record(self, step: str, **found: Any) -> None:
        create_once(self.spark, f"{self.folder}/{self.run}/{step}", json.dumps(found))
