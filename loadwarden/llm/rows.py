"""Row identity, intermediate tables and Arrow maps that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadwarden.scratch import scratch_path

ROW_ID = "_row_id"

# Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]*"

#: The most rows of a stored table that Spark may broadcast; of some numbers each they take about 10 MB.
BROADCAST_ROWS = 100_000


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, and not lost with an executor.

    ``compression`` is for copies of texts; other tables take the session's.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table, or columns of one, as a side of a join; sorted and never broadcast if it has many ``rows``.

    Spark takes the size of compressed files for that of the rows, many of which then may not fit the driver.
    """
    return df if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df.hint("merge")


def row_id() -> Column:
    """A number for each row of a scan; rows of a frame that is computed again may get others."""
    return F.monotonically_increasing_id()


def packed(docs: DataFrame) -> DataFrame:
    """A row number and the whole row as ``doc``, so that no column clashes with an added one."""
    return docs.select(row_id().alias(ROW_ID), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))


def unpacked(
    df: DataFrame, docs: DataFrame, new: dict[str, Column] | None = None, more: dict[str, Column] | None = None
) -> DataFrame:
    """The columns of ``docs`` from ``doc``; those in ``new`` replaced, with the types they had.

    Columns of ``more`` are added; one whose name ``docs`` has already gets an underscore before it.
    """
    new = new or {}
    columns = [
        (new[f.name].cast(f.dataType) if f.name in new else F.col(f"doc.`{f.name}`")).alias(f.name)
        for f in docs.schema
    ]
    taken = {c.lower() for c in docs.columns}
    for name, column in (more or {}).items():
        while name.lower() in taken:
            name = f"_{name}"
        columns.append(column.alias(name))
    return df.select(*columns)


def arrow_map(
    df: DataFrame,
    function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``df`` through ``function`` in each task; a worker gives its free memory back after it.

    Workers live on from task to task, and their libraries would keep what they freed.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _same_stage()
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return df.mapInArrow(run, schema)


#: What a worker keeps from task to task of one stage, and the number of that stage.
_KEPT: dict[Hashable, Any] = {}
_STAGE: list[int | None] = [None]


def _same_stage() -> None:
    context = TaskContext.get()
    stage = None if context is None else context.stageId()
    if _STAGE[0] != stage:
        _KEPT.clear()
        _STAGE[0] = stage


def kept_in_stage(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per worker and stage."""
    _same_stage()
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def hash_fraction(key: Column, fraction: float, seed: int) -> Column:
    """True for a fixed, evenly spread share of the keys, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int(min(1.0, fraction) * (1 << 30))


def pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most_bytes`` at most, or of a single larger row."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            size = batch.num_rows - start
            while size > 1 and batch.slice(start, size).nbytes > most_bytes:
                size = (size + 1) // 2
            yield batch.slice(start, size)
            start += size
