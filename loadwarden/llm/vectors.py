"""Near-duplicate vectors by cosine, compared within cells of spherical k-means.

Vectors are made unit vectors in double precision; equal ones are one class.
Cells are fitted on a bounded sample, evenly spread by a hash of the vectors.
Centroids that lie as close as linked vectors do are merged, so that a tight
group is not cut up. A class is posted to its ``PROBES`` nearest cells, and two
classes are compared in the first cell they share, as blocked products.

A class within half the linking angle of its centroid is in the cell's core.
All of a core is linked with each other, by the triangle inequality, so it is
counted and joined without being compared; and only classes within one and a
half linking angles of the centroid, its shell, can be linked with it. Those are
posted to the cell as well and compared with the core, in blocks. However large a
tight group is, it costs a row per vector then, and none at all beyond that
where nothing lies near it.

Links are counted exactly wherever two classes share a cell. Only the nearest
cells are probed, so a link is lost if two classes share none of them; recall
against brute force is part of the tests.

Cases: a vector that is null, of zeros, or with null or non-finite components
links with nothing and is its own component, also if vec_id is null; vectors of
another length never link; rows with the same vec_id are one vector to the
graph but are counted; without rows there is no result; other columns, labels
among them, play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.blocks import Merger, block_pairs, each_block_pair
from loadwarden.llm.components import components
from loadwarden.llm.rows import ROW_ID, arrow_map, hash_fraction, row_id, stored

CELL_SIZE = 256
MOST_CELLS = 16_384
PROBES = 4
BLOCK = 512
#: The sample that cells are fitted on has at most so many bytes, and so many vectors per cell.
SAMPLE_BYTES = 48 << 20
SAMPLE_PER_CELL = 24
ROUNDS = 8
SEED = 5


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, unit, key): each vector at length 1 as doubles, and a digest of it; or nulls."""

    def scale(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, keys = [], []
            for value in batch.column("embedding"):
                unit = _unit(value)
                units.append(unit)
                keys.append(hashlib.blake2b(unit, digest_size=16).digest() if unit else None)
            columns = [*batch.columns[:2], pa.array(units, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [ROW_ID, "vec_id", "unit", "key"])

    return arrow_map(
        vectors.select(row_id().alias(ROW_ID), F.col("vec_id").cast("long"), "embedding"),
        scale,
        f"{ROW_ID} bigint, vec_id bigint, unit binary, key binary",
    )


def _unit(value: pa.Scalar) -> bytes | None:
    if not value.is_valid or not len(value.values) or value.values.null_count:
        return None
    x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return (x / math.sqrt(float(x @ x)) + 0.0).astype("<f8").tobytes()


def _step(cells: int) -> int:
    """Rows whose products with all cells are a few megabytes."""
    return max(1, (1 << 20) // max(1, cells))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = _step(len(centroids))
    return np.concatenate(
        [(x[a : a + step] @ centroids.T).argmax(axis=1) for a in range(0, len(x), step)]
    )


def spherical_kmeans(sample: np.ndarray, cells: int, least: float, seed: int = SEED) -> np.ndarray:
    """Unit centroids; of those with a cosine of ``least`` or more to an earlier one none is left."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        alive = norms > 1e-9
        centroids = sums[alive] / norms[alive, None]
    left = np.ones(len(centroids), bool)
    for i in range(len(centroids)):
        if left[i]:
            near = centroids[i + 1 :] @ centroids[i] >= least
            left[i + 1 :] &= ~near
    # A merged group's centroid moves to the middle of all that lies there now.
    centroids = centroids[left]
    nearest = _nearest(sample, centroids)
    close = (sample * centroids[nearest]).sum(axis=1) >= least
    sums = centroids * 1e-6
    np.add.at(sums, nearest[close], sample[close])
    moved = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    step, apart = _step(len(moved)), np.empty(len(moved), bool)
    for a in range(0, len(moved), step):
        near = moved[a : a + step] @ moved.T
        near[np.arange(len(near)), a + np.arange(len(near))] = -1
        apart[a : a + step] = near.max(axis=1) < least
    return np.where(apart[:, None], moved, centroids)


def _fitted(classes: DataFrame, least: float) -> dict[int, np.ndarray]:
    """Centroids for each vector length, from a sample; lengths that are not in it have none."""
    n = classes.count()
    cells = min(MOST_CELLS, max(1, n // CELL_SIZE))
    widest = classes.agg(F.max(F.octet_length("unit"))).first()[0] or 8
    most = min(SAMPLE_PER_CELL * cells, SAMPLE_BYTES // widest)
    rows = classes.where(hash_fraction(F.col("key"), most / max(1, n), SEED)).select("key", "unit").collect()
    rows.sort(key=lambda r: r["key"])
    by_length: dict[int, list[bytes]] = {}
    for r in rows:
        by_length.setdefault(len(r["unit"]) // 8, []).append(r["unit"])
    return {
        d: spherical_kmeans(np.frombuffer(b"".join(units), "<f8").reshape(-1, d), cells, least)
        for d, units in by_length.items()
    }


def _posted(classes: DataFrame, centroids: dict[int, np.ndarray], least: float) -> DataFrame:
    """(node, n, unit, core, cells, shells) per class: its core cell or -1, the cells it is posted
    to, nearest first, and the cells whose core it may be linked with."""
    shared = classes.sparkSession.sparkContext.broadcast(centroids)
    angle = math.acos(least)
    inner, outer = math.cos(angle / 2 * (1 - 1e-9)), math.cos(min(math.pi, angle * 1.5 * (1 + 1e-9)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit")
            widths = pc.binary_length(units).to_numpy() // 8
            core = np.full(len(units), -1, np.int64)
            cells: list = [None] * len(units)
            shells: list = [None] * len(units)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                x = np.frombuffer(b"".join(units.take(pa.array(rows)).to_pylist()), "<f8").reshape(-1, width)
                middle = shared.value.get(width)
                # Cells of another vector length have numbers of their own.
                base = width * MOST_CELLS
                if middle is None:
                    for r in rows.tolist():
                        cells[r], shells[r] = [base], []
                    continue
                step = _step(len(middle))
                for a in range(0, len(rows), step):
                    near = x[a : a + step] @ middle.T
                    order = np.argsort(-near, axis=1, kind="stable")[:, :PROBES]
                    for k, r in enumerate(rows[a : a + step].tolist()):
                        best = int(order[k, 0])
                        if near[k, best] >= inner:
                            core[r], cells[r] = base + best, []
                        else:
                            cells[r] = (base + order[k]).tolist()
                        around = np.flatnonzero(near[k] >= outer)
                        shells[r] = [base + c for c in around.tolist() if base + c != core[r]]
            kind = pa.list_(pa.int64())
            columns = [
                batch.column("node"),
                batch.column("n"),
                units,
                pa.array(core),
                pa.array(cells, kind),
                pa.array(shells, kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "unit", "core", "cells", "shells"])

    return arrow_map(
        classes.select("node", "n", "unit"),
        assign,
        "node bigint, n bigint, unit binary, core bigint, cells array<bigint>, shells array<bigint>",
    )


def _matrix(table: pa.Table) -> np.ndarray:
    data = b"".join(table["unit"].to_pylist())
    return np.frombuffer(data, "<f8").reshape(table.num_rows, -1)


def _found(nodes: np.ndarray, links: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch | None:
    """Rows of links counted per node, and rows of edges that connect what is linked."""
    linked = np.flatnonzero(links)
    if not len(linked):
        return None
    a = [nodes[i] for i, _ in edges]
    b = [nodes[j] for _, j in edges]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([nodes[linked], np.array(a, np.int64)])),
            pa.array([None] * len(linked) + b, pa.int64()),
            pa.array(np.concatenate([links[linked], np.zeros(len(a), np.int64)])),
        ],
        ["a", "b", "links"],
    )


def _tally(i: np.ndarray, j: np.ndarray, near: np.ndarray, n: np.ndarray, links: np.ndarray, merger: Merger, edges: list) -> None:
    """Add the links in the matrix ``near`` of rows i and columns j."""
    links[i] += near @ n[j]
    links[j] += near.T @ n[i]
    for x in range(len(i)):
        columns = np.flatnonzero(near[x])
        for y in j[columns].tolist():
            if merger.join(int(i[x]), y):
                edges.append((int(i[x]), y))


def _within_cells(posted: DataFrame, least: float) -> DataFrame:
    """Links between classes outside cores, each pair in the first cell that both are posted to."""
    rows = (
        posted.where("core < 0")
        .withColumn("cell", F.explode("cells"))
        .withColumn("earlier", F.filter("cells", lambda c: c < F.col("cell")))
    )

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        nodes, n, own = (table[c].to_numpy() for c in ("node", "n", "_own"))
        x = _matrix(table)
        i, j = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
        near = x[i] @ x[j].T >= least
        earlier = table["earlier"].combine_chunks()
        which = np.repeat(np.arange(len(nodes)), pc.list_value_length(earlier).to_numpy())
        cells, at = np.unique(earlier.flatten().to_numpy(), return_inverse=True)
        if near.any() and len(cells):
            posted_to = np.zeros((len(nodes), len(cells)), np.float32)
            posted_to[which, at] = 1
            near &= posted_to[i] @ posted_to[j].T == 0
        if own.min() == own.max():
            near = np.triu(near, 1)
        links, merger, edges = np.zeros(len(nodes), np.int64), Merger(len(nodes)), []
        _tally(i, j, near.astype(np.int64), n, links, merger, edges)
        return _found(nodes, links, edges)

    return each_block_pair(
        block_pairs(rows, "cell", "node", BLOCK),
        "cell",
        compare,
        "a bigint, b bigint, links bigint",
        ["node", "n", "unit", "earlier"],
    )


def _around_cores(posted: DataFrame, least: float) -> DataFrame:
    """Links between a cell's core and its shell, blocks of the one with blocks of the other.

    Two cores' members are compared in the cell with the smaller number.
    """
    core = posted.where("core >= 0").select(F.col("core").alias("cell"), "node", "n", "unit", F.lit(0).alias("side"))
    shell = (
        posted.withColumn("cell", F.explode("shells"))
        .where("core < 0 or cell < core")
        .select("cell", "node", "n", "unit", F.lit(1).alias("side"))
    )
    sizes = (
        core.select("cell", "side")
        .union(shell.select("cell", "side"))
        .groupBy("cell")
        .agg(F.count(F.when(F.col("side") == 0, 1)).alias("_c"), F.count(F.when(F.col("side") == 1, 1)).alias("_s"))
        .where("_c > 0 and _s > 0")
        .select("cell", F.ceil(F.col("_c") / BLOCK).cast("int").alias("_c"), F.ceil(F.col("_s") / BLOCK).cast("int").alias("_s"))
    )
    place = F.pmod(F.xxhash64(F.lit(9), "node"), F.when(F.col("side") == 0, F.col("_c")).otherwise(F.col("_s"))).cast("int")
    across = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("_s")).otherwise(F.col("_c")) - 1))
    paired = (
        core.union(shell)
        .join(sizes, "cell")
        .withColumn("_place", place)
        .withColumn("_across", across)
        .withColumn("_i", F.when(F.col("side") == 0, F.col("_place")).otherwise(F.col("_across")))
        .withColumn("_j", F.when(F.col("side") == 0, F.col("_across")).otherwise(F.col("_place")))
        .withColumn("_own", F.col("side"))
    )

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        nodes, n, own = (table[c].to_numpy() for c in ("node", "n", "_own"))
        i, j = np.flatnonzero(own == 0), np.flatnonzero(own == 1)
        if not len(i) or not len(j):
            return None
        x = _matrix(table)
        near = (x[i] @ x[j].T >= least).astype(np.int64)
        links, merger, edges = np.zeros(len(nodes), np.int64), Merger(len(nodes)), []
        _tally(i, j, near, n, links, merger, edges)
        return _found(nodes, links, edges)

    return each_block_pair(
        paired, "cell", compare, "a bigint, b bigint, links bigint", ["node", "n", "unit"]
    )


def near_vectors(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector, linked at a cosine of ``least``."""
    if not 0 < least < 1:
        raise ValueError("the least cosine lies between 0 and 1")
    rows = stored(unit_vectors(vectors), "units")
    usable = rows.where("key is not null")
    classes = stored(
        usable.groupBy("key").agg(
            F.min("vec_id").alias("vec_id"),
            F.min(ROW_ID).alias("node"),
            F.count(F.lit(1)).alias("n"),
            F.first("unit").alias("unit"),
        ),
        "classes",
    )
    posted = stored(_posted(classes, _fitted(classes, least), least), "posted")
    found = stored(_within_cells(posted, least).union(_around_cores(posted, least)), "links")
    # A core's classes are all linked: their number is counted, and each is tied to the first one.
    cores = posted.where("core >= 0").groupBy("core").agg(F.sum("n").alias("all"), F.min("node").alias("first"))
    in_core = posted.where("core >= 0").select("core", "node", "n").join(cores, "core")
    links = (
        found.where("b is null")
        .select(F.col("a").alias("node"), "links")
        .union(in_core.select("node", F.col("all") - F.col("n")))
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    tied = found.where("b is not null").select("a", "b").union(in_core.select("node", F.col("first")))
    groups = components(tied)
    # Components of classes first, then of vec_ids: the smallest one of each.
    of_class = (
        classes.join(groups, "node", "left")
        .join(links, "node", "left")
        .select(
            "key",
            "n",
            "vec_id",
            F.coalesce("component", "node").alias("group"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    smallest = of_class.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    known = of_class.join(smallest, "group").select("key", "n_links", "component_id")
    return rows.join(known, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
