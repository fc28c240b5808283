"""Spark sessions sized for the data they will read."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024**2

# Load stamps and run dates are text and dates of the session time zone, so it
# is pinned. The joins rely on adaptive execution: it splits the partition of a
# hot key and merges small shuffle partitions. Joins sort, and so can spill.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * MIB),
}


def sizing_conf(
    input_bytes: int,
    *,
    map_tasks: int = 100_000,
    bytes_per_reducer: int = 512 * MIB,
    least_split: int = 128 * MIB,
    least_reducers: int = 200,
) -> dict[str, str]:
    """Scan split and first shuffle width for a job that reads ``input_bytes``.

    Splits grow with the input so that there are about ``map_tasks`` of them, and every
    reducer gets ``bytes_per_reducer``, at any size. The shuffle has map tasks times
    reducers blocks; where these become too many, more bytes per reducer are the way. Adaptive
    execution merges what is too fine.
    """
    split = max(input_bytes // map_tasks, least_split)
    reducers = max(-(-input_bytes // bytes_per_reducer), least_reducers)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(reducers),
        # Merge up to the advisory size, which is also the size of the files written.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with ``BASE_CONF``, sized by ``input_bytes`` when it is given.

    ``conf`` wins over both.
    """
    settings = dict(BASE_CONF)
    if input_bytes is not None:
        settings.update(sizing_conf(input_bytes))
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
