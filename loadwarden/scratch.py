"""A place for tables that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to the machine's own
    temporary folder; on a cluster other executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other call gets; nothing is created there yet.

    All paths of an application lie in one folder, which can be removed when it has ended.
    """
    root = scratch_root(spark)
    return f"{root}/loadwarden-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
