"""Turns of conversations in order, without a task or a group that holds a long conversation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART, AT = "_part", "_at"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the digest of the last two; null roles and texts are empty.

    The digest, with the role's length before it, also orders turns of equal number.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(said.cast("binary"))).alias("digest"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with conv_id, turn and digest, sorted over all partitions; nulls come first.

    The row number in the ranges lets rows that are alike fall into several partitions.
    """
    columns = rows.columns
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("_row")]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select(*columns)


class Runs:
    """Place and size so far of each row in the run of rows with its conv_id, from batch to batch."""

    def __init__(self) -> None:
        self.key: tuple | None = None
        self.rows = self.size = 0

    def place(self, keys: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = keys.fill_null(0).to_numpy()
        nulls = keys.is_null().to_numpy(zero_copy_only=False)
        changes = (values[1:] != values[:-1]) | (nulls[1:] != nulls[:-1])
        starts = np.concatenate(([self.key != (values[0], nulls[0])], changes))
        before = np.cumsum(sizes) - sizes
        first = np.flatnonzero(starts)
        run = np.cumsum(starts)  # 0: the run that the last batch ended in
        at = np.arange(len(values)) - np.concatenate(([-self.rows], first))[run]
        so_far = before - np.concatenate(([-self.size], before[first]))[run]
        self.key = (values[-1], nulls[-1])
        self.rows, self.size = int(at[-1]) + 1, int(so_far[-1]) + int(sizes[-1])
        return at, so_far


def segments(placed: DataFrame, *sizes: Column) -> DataFrame:
    """conv_id, the part, its rows there (``n``) and what columns add up to: a row per part that it lies in."""
    return placed.groupBy("conv_id", PART).agg(F.count(F.lit(1)).alias("n"), *sizes)


def earlier(of_parts: DataFrame, **names: str) -> DataFrame:
    """The segments with sums over the same conversation's earlier parts: ``new=old`` column names.

    A conversation has at most a row per part here, however long it is.
    """
    before = W.partitionBy("conv_id").orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    for new, old in names.items():
        of_parts = of_parts.withColumn(new, F.coalesce(F.sum(old).over(before), F.lit(0)))
    return of_parts


def placed_over_parts(placed: DataFrame, of_parts: DataFrame, **added: str) -> DataFrame:
    """``placed`` with the sums in ``of_parts`` added to columns: ``column=sum``.

    Parts are ranges, so only the first conversation of a part can have begun before it: a row
    per part at most is broadcast.
    """
    begun = of_parts.where(" or ".join(f"{s} > 0" for s in added.values()))
    begun = begun.select(F.col("conv_id").alias("_conv"), F.col(PART).alias("_begun"), *added.values())
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col(PART) == F.col("_begun"))
    joined = placed.join(F.broadcast(begun), same, "left")
    for name, total in added.items():
        joined = joined.withColumn(name, F.col(name) + F.coalesce(total, F.lit(0)))
    return joined.drop("_conv", "_begun", *added.values())
