"""The prefix trie of conversations: what they share from their first turn on.

Every prefix of a conversation has a digest. A count-min sketch of all digests,
of fixed size, tells which prefixes can be shared: an estimate of one proves
that no other conversation begins so, and whatever follows is proved with it.
Nodes of such tails are made where their turns are; only prefixes that may be
shared are shuffled, and grouped exactly. The sketch grows with the number of
turns up to ``MOST_WIDTH`` counters a row; beyond that it proves less, and the
grouping, which decides, has more to do.

Nodes of a conversation that are its own, since it is the smallest one there,
are always its deepest ones, so one depth per conversation tells which they are.
Children, leaves and saved code points of a node are then sums over the
conversations in it: no walk over the tree, no row per pair of nodes.

Digests of prefixes are the exclusive or of hashed pairs (depth, digest of the
turn), of 128 bits: they can be put together from the parts of a conversation,
so turns are dealt by ranges, and a conversation of any length over many tasks.

Cases: turns go by their number, null first, and equal numbers by a digest of
role and text; null roles and texts are empty; repeated rows are turns like
others; rows without a conv_id are no conversation; no rows make no node, not
even a root; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map, stored
from loadwarden.llm.turns import AT, PART, Runs, earlier, in_order, placed_over_parts, segments, turn_rows

#: Rows of counters in the sketch, and the least and most counters of a row.
ROWS, LEAST_WIDTH, MOST_WIDTH = 4, 1 << 16, 1 << 24
#: Counters that are merged together.
SLICE = 1 << 16
#: A group of more than a share of all rows, or of more than so many rows, is looked up by broadcast.
HOT_SHARE, HOT_ROWS = 10_000, 64
#: Conversations whose numbers are put into one text for hashing.
CHUNK = 8_192
NODE = ["depth", "x1", "x2"]


def number_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, part, at, digest, chars), ``at`` from 0, and (conv_id, n) of each conversation."""
    turns = turn_rows(conversations.where("conv_id is not null"))
    slim = turns.select("conv_id", "turn", "digest", F.length("text").cast("long").alias("chars"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, part = Runs(), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                at, _ = runs.place(batch.column("conv_id"), np.zeros(batch.num_rows, np.int64))
                columns = [batch.column("conv_id"), pa.array([part] * len(at), pa.int64()), pa.array(at)]
                columns += [batch.column("digest"), batch.column("chars")]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", PART, AT, "digest", "chars"])

    schema = f"conv_id bigint, {PART} bigint, {AT} bigint, digest binary, chars bigint"
    placed = stored(arrow_map(in_order(slim), place, schema), "turns")
    of_parts = earlier(segments(placed), _n_before="n")
    convs = of_parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    return placed_over_parts(placed, of_parts, **{AT: "_n_before"}), convs


def rebuilt(turns: DataFrame, convs: DataFrame, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """The conversations with the first turns of another one in place of their own.

    Conversation c begins with the first h turns of c - c % block, all if there are fewer, with
    h = crc32(c in digits) % heads, and goes on with its own after its first h. Rows are
    (conv_id, part, depth, digest, chars), depth from 1; the second frame has each one's ``length``.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("long")
    of_base = convs.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n_base"))
    lengths = stored(
        convs.withColumn("_h", h)
        .withColumn("_base", c - c % block)
        .join(of_base, "_base", "left")
        .withColumn("_head", F.least("_h", F.coalesce("_n_base", F.lit(0))))
        .select("conv_id", "_base", "_h", "_head", (F.col("_head") + F.greatest(F.col("n") - F.col("_h"), F.lit(0))).alias("length")),
        "lengths",
    )
    first = turns.where(F.col(AT) < heads - 1).select(F.col("conv_id").alias("_base"), AT, "digest", "chars")
    head = (
        lengths.where("_head > 0")
        .join(first, "_base")
        .where(F.col(AT) < F.col("_head"))
        .select("conv_id", F.lit(-1).cast("long").alias(PART), (F.col(AT) + 1).alias("depth"), "digest", "chars")
    )
    # Dealt by conversation and part, so that a long conversation is many groups.
    own = turns.where(F.col(AT) >= h)
    of_parts = own.select("conv_id", PART).distinct().join(lengths.select("conv_id", "_h", "_head"), "conv_id")
    rest = own.join(of_parts, ["conv_id", PART]).select(
        "conv_id", PART, (F.col(AT) - F.col("_h") + F.col("_head") + 1).alias("depth"), "digest", "chars"
    )
    return head.union(rest), lengths.select("conv_id", "length")


def with_prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each prefix of each conversation, the empty one included.

    (x1, x2) is its digest and (p1, p2) that of the prefix one turn shorter; ``chars`` are those
    of its last turn, ``so_far`` of all, and ``last`` tells whether it is the whole conversation.
    """

    def lane(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "depth", "digest")

    part = W.partitionBy("conv_id", PART).orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    own = turns.withColumn("t1", lane(1)).withColumn("t2", lane(2))
    totals = segments(own, F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"), F.sum("chars").alias("s3"))
    before = W.partitionBy("conv_id").orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = totals.join(lengths, "conv_id").select(
        "conv_id",
        PART,
        "length",
        F.coalesce(F.bit_xor("s1").over(before), zero).alias("o1"),
        F.coalesce(F.bit_xor("s2").over(before), zero).alias("o2"),
        F.coalesce(F.sum("s3").over(before), zero).alias("o3"),
    )
    running = (
        own.withColumn("x1", F.bit_xor("t1").over(part))
        .withColumn("x2", F.bit_xor("t2").over(part))
        .withColumn("so_far", F.sum("chars").over(part))
    )
    whole = running.join(offsets, ["conv_id", PART])
    x1, x2 = (F.col(f"x{k}").bitwiseXOR(F.col(f"o{k}")) for k in (1, 2))
    prefixes = whole.select(
        "conv_id",
        PART,
        "depth",
        x1.alias("x1"),
        x2.alias("x2"),
        x1.bitwiseXOR(F.col("t1")).alias("p1"),
        x2.bitwiseXOR(F.col("t2")).alias("p2"),
        "chars",
        (F.col("so_far") + F.col("o3")).alias("so_far"),
        (F.col("depth") == F.col("length")).alias("last"),
    )
    root = lengths.select(
        "conv_id",
        F.lit(-2).cast("long").alias(PART),
        *(zero.alias(name) for name in ("depth", "x1", "x2", "p1", "p2", "chars", "so_far")),
        (F.col("length") == 0).alias("last"),
    )
    return stored(root.union(prefixes), "prefixes")


class Sketch:
    """Which counters of a count-min sketch were met twice at least; counting stops there."""

    def __init__(self, width: int, twice: np.ndarray | None = None):
        self.width, self.shift = width, np.uint64(64 - width.bit_length() + 1)
        self.twice = twice

    def cells(self, x1: np.ndarray, x2: np.ndarray) -> list[np.ndarray]:
        """The counter of each digest in each row."""
        a, b = x1.view(np.uint64), x2.view(np.uint64) | np.uint64(1)
        return [((a + np.uint64(r) * b) >> self.shift).astype(np.int64) + r * self.width for r in range(ROWS)]

    def single(self, x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
        """Whether the estimate is one: no other conversation has this prefix."""
        shared = np.ones(len(x1), bool)
        for cells in self.cells(x1, x2):
            shared &= (self.twice[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
        return ~shared


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("x1").to_numpy(), batch.column("x2").to_numpy()


def count_prefixes(prefixes: DataFrame, width: int | None = None) -> Sketch:
    """The sketch of all prefixes: a part of it per task, merged by slices, at most 8 MB on the driver."""
    if width is None:
        n = prefixes.count()
        width = min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (2 * n).bit_length()))
    empty = Sketch(width)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(ROWS * width, np.uint8)
        for batch in batches:
            for cells in empty.cells(*_digests(batch)):
                found, n = np.unique(cells, return_counts=True)
                met[found] = np.minimum(2, met[found] + np.minimum(n, 2))
        slices = met.reshape(-1, SLICE)
        for k in np.flatnonzero(slices.any(axis=1)).tolist():
            of_slice = slices[k]
            dense = np.count_nonzero(of_slice) > SLICE // 16
            pair = [
                np.packbits(of_slice >= n) if dense else np.flatnonzero(of_slice == n).astype("<u2") for n in (1, 2)
            ]
            columns = [pa.array([k], pa.int32()), pa.array([dense])]
            columns += [pa.array([data.tobytes()], pa.binary()) for data in pair]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "dense", "one", "two"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                of_slice = met.setdefault(row["slice"], np.zeros(SLICE, np.uint8))
                if row["dense"]:
                    more = sum(np.unpackbits(np.frombuffer(row[name], np.uint8)) for name in ("one", "two"))
                    np.minimum(2, of_slice + more, out=of_slice)
                    continue
                for n, name in ((1, "one"), (2, "two")):
                    at = np.frombuffer(row[name], "<u2")
                    of_slice[at] = np.minimum(2, of_slice[at] + n)
        if met:
            twice = [np.packbits(of_slice >= 2).tobytes() for of_slice in met.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(met), pa.int32()), pa.array(twice)], ["slice", "twice"])

    parts = arrow_map(prefixes.select("x1", "x2"), count, "slice int, dense boolean, one binary, two binary")
    merged = arrow_map(parts.repartition("slice"), merge, "slice int, twice binary")
    bits = np.zeros((ROWS * width // SLICE, SLICE // 8), np.uint8)
    for row in merged.collect():
        bits[row["slice"]] = np.frombuffer(row["twice"], np.uint8)
    return Sketch(width, bits.reshape(-1))


def screened(prefixes: DataFrame, sketch: Sketch) -> DataFrame:
    """The prefixes with ``single``, proved to be of one conversation, and ``inner``: so is the one before, here."""
    shared = prefixes.sparkSession.sparkContext.broadcast(sketch)
    names = prefixes.columns

    def screen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            single = shared.value.single(*_digests(batch))
            conv, depth = (batch.column(c).to_numpy() for c in ("conv_id", "depth"))
            follows = (conv[1:] == conv[:-1]) & (depth[1:] == depth[:-1] + 1) & single[:-1]
            goes_on = last[0] == conv[0] and last[1] == depth[0] - 1 and last[2]
            inner = single & np.concatenate(([goes_on], follows))
            last = (conv[-1], depth[-1], single[-1])
            columns = [*batch.columns, pa.array(single), pa.array(inner)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "single", "inner"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return stored(arrow_map(prefixes, screen, f"{schema}, single boolean, inner boolean"), "screened")


def _ends(shared: DataFrame) -> DataFrame:
    """The digest of the numbers of the conversations that end in a node, in ascending order.

    They are sorted over all partitions, so that the conversations of one node lie in many, and
    go on as texts of many numbers each, which one task per node reads one after the other.
    """
    key = ["x1", "x2", "depth"]

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in key])
            cut = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            bounds = np.concatenate(([0], np.flatnonzero(cut) + 1, [batch.num_rows]))
            bounds = np.unique(np.concatenate((bounds, np.arange(0, batch.num_rows, CHUNK))))
            ids = batch.column("conv_id").to_pylist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(bounds, bounds[1:])]
            at = pa.array(bounds[:-1])
            columns = [batch.column(c).take(at) for c in (*key, "conv_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*key, "conv_id", "ids"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []
        for batch in batches:
            for *node, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node != now:
                    if now is not None:
                        rows.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if len(rows) >= 4096:
                yield made(rows)
                rows = []
        if now is not None:
            yield made([*rows, (*now, state.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        *keys, hexes = zip(*rows)
        columns = [*(pa.array(k, pa.int64()) for k in keys), pa.array(hexes, pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*key, "ends_sha256"])

    ends = shared.where("last").select(*key, "conv_id").repartitionByRange(*key, "conv_id")
    joined = arrow_map(
        ends.sortWithinPartitions(*key, "conv_id"), join, "x1 bigint, x2 bigint, depth bigint, conv_id bigint, ids string"
    )
    dealt = joined.repartition(*key).sortWithinPartitions(*key, "conv_id")
    return arrow_map(dealt, digest, "x1 bigint, x2 bigint, depth bigint, ends_sha256 string")


def _first_nodes(groups: DataFrame, tails: DataFrame, shared: DataFrame) -> DataFrame:
    """For each conversation the first node that is its own, one past its end if none is.

    (conv_id, own, before, leaf, parent): its depth, the code points before it, whether the
    conversation's end is a leaf of its own, and the smallest conversation in the node above.
    """
    none = F.lit(None).cast("long")
    firsts = (
        groups.select("conv_id", "depth", "p1", "p2", "before", (F.col("n") == F.col("n_ends")).alias("leaf"))
        .union(
            tails.select("conv_id", "depth", "p1", "p2", (F.col("so_far") - F.col("chars")).alias("before"), F.lit(True))
        )
        .union(
            shared.where("last").select(
                "conv_id", F.col("depth") + 1, none.alias("p1"), none.alias("p2"), "so_far", F.lit(False)
            )
        )
        .groupBy("conv_id")
        .agg(F.min(F.struct("depth", "p1", "p2", "before")).alias("f"), F.bool_or("leaf").alias("leaf"))
        .select("conv_id", F.col("f.depth").alias("own"), "f.p1", "f.p2", "f.before", "leaf")
    )
    firsts = stored(firsts, "first_nodes")
    # The node above has the digest (p1, p2). Nodes of very many conversations are few, and broadcast.
    above = groups.select(
        (F.col("depth") + 1).alias("own"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
        F.col("conv_id").alias("parent"), "n",
    )
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.col("n") > max(HOT_ROWS, total // HOT_SHARE)
    key = ["own", "p1", "p2"]
    below = firsts.where("own > 0 and p1 is not null")
    found = below.join(F.broadcast(above.where(hot).drop("n")), key, "left")
    rest = found.where("parent is null").drop("parent").join(above.where(~hot).drop("n"), key, "left")
    parents = found.where("parent is not null").select("conv_id", "parent").union(rest.select("conv_id", "parent"))
    return stored(firsts.drop("p1", "p2").join(parents, "conv_id", "left"), "own_nodes")


def prefix_trie(prefixes: DataFrame, width: int | None = None) -> DataFrame:
    """A row per node of the trie of ``with_prefixes``; ``width`` sets the counters in a row of the sketch.

    ``conv_id`` is the smallest conversation in the node, ``parent_conv_id`` that of the node above.
    """
    seen = screened(prefixes, count_prefixes(prefixes, width))
    shared, tails = seen.where("not single"), seen.where("single and not inner")
    groups = stored(
        shared.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("last").alias("n_ends"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.min(F.col("so_far") - F.col("chars")).alias("before"),
        ),
        "groups",
    )
    own = _first_nodes(groups, tails, shared)
    c = F.col("conv_id")
    parent = F.when(F.col("depth") > F.col("own"), c).otherwise(F.col("parent"))

    def found(*columns: Column) -> list[Column]:
        names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        return ["conv_id", "depth", *(column.alias(name) for column, name in zip(columns, names))]

    def of_one(parent: Column) -> list[Column]:
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        ends = F.sha2(F.when(F.col("last"), c.cast("string")).otherwise("").cast("binary"), 256)
        return found(parent, one, F.when(F.col("last"), zero).otherwise(one), one, zero, ends)

    of_parts = shared.select("conv_id", PART).distinct().join(own, "conv_id")
    saved = F.greatest(F.col("before") - (F.col("so_far") - F.col("chars")), F.lit(0))
    sums = (
        shared.join(of_parts, ["conv_id", PART])
        .groupBy(*NODE)
        .agg(
            F.min(F.struct("conv_id", parent.alias("parent"))).alias("least"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("last") & (F.col("own") <= F.col("depth") + 1)).alias("children"),
            F.count_if("leaf").alias("leaves"),
            F.sum(saved).alias("saved"),
        )
        .join(_ends(shared), NODE, "left")
        .select(
            F.col("least.conv_id").alias("conv_id"), "depth", "least.parent", "n", "children", "leaves", "saved",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends"),
        )
    )
    grouped = sums.select(*found(*map(F.col, ("parent", "n", "children", "leaves", "saved", "ends"))))
    inner = seen.where("inner").select(*of_one(c))
    first = tails.join(own.select("conv_id", "own", "parent"), "conv_id").select(*of_one(parent))
    return grouped.union(inner).union(first)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns, convs = number_turns(conversations)
    rows = turns.select("conv_id", PART, (F.col(AT) + 1).alias("depth"), "digest", "chars")
    return prefix_trie(with_prefixes(rows, convs.select("conv_id", F.col("n").alias("length"))))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that begin with turns of others, as ``rebuilt`` makes them."""
    return prefix_trie(with_prefixes(*rebuilt(*number_turns(conversations))))
