"""Groups of rows compared in blocks, so that no task holds a large group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map


def block_pairs(rows: DataFrame, group: str, row: str, block: int) -> DataFrame:
    """The rows once for each pair of blocks (``_i``, ``_j``) of their group that they are in.

    A group of at most ``block`` rows is one block, paired with itself. A larger one is
    dealt by a hash of ``row`` to blocks, all of which are paired; ``_own`` is a row's block.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shares = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), row), F.col("_blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, _blocks - 1)"))
    return (
        rows.join(sizes.select(group, shares.alias("_blocks")), group)
        .withColumn("_own", own)
        .withColumn("_other", other)
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other", "_blocks")
    )


def each_block_pair(
    paired: DataFrame,
    group: str,
    function: Callable[[pa.Table], pa.RecordBatch | None],
    schema: str,
    columns: list[str],
) -> DataFrame:
    """``function`` of the rows of every pair of blocks; they are shuffled to one place and sorted."""
    key = [group, "_i", "_j"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in key])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                now = tuple(keys[:, a])
                if now != last and held:
                    yield from filter(None, [function(pa.Table.from_batches(held))])
                    held = []
                held.append(batch.slice(a, b - a))
                last = now
        if held:
            yield from filter(None, [function(pa.Table.from_batches(held))])

    dealt = paired.repartition(*key).sortWithinPartitions(*key)
    return arrow_map(dealt.select(*key, "_own", *columns), run, schema)


class Merger:
    """Sets that are joined pair by pair; ``join`` tells whether the two were apart."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
