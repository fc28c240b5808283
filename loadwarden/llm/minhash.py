"""Near-duplicate documents by an inverted join over MinHash signatures.

A document's set are the digests of its runs of five words. Documents with the
same words are one class, and only a class's first document goes on. Every
signature coordinate and value is a posting list. Pairs that are to share at
least ``m`` coordinates, as many as ``least_matches`` gives for the similarity asked
for, must share one of any ``COORDINATES - m + 1`` of them, so a document is posted under its rarest values only (the prefix);
values of its own need no posting, and lists with the same members are merged
once. Within a list, signatures are compared in blocks, and of the pairs above
the match threshold those that connect their documents are kept (the skip).

Documents connected that way are candidates of each other. In each group of
candidates all pairs above the match threshold are confirmed on their full sets, in
blocks of bounded size, unless the two are known to be in one component. So no
link between components is missed but for those whose signatures agree by five
standard deviations less than expected, and neither pairs nor sets of a large
group meet in one task.

Cases: null, empty and blank texts have an empty set, link with nothing and are
kept, each a component of its own; a null doc_id gets no component (null) and is kept, but
does link others; rows with the same doc_id are one document to the graph;
without documents there is no result; columns besides doc_id and text play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.blocks import Merger, block_pairs, each_block_pair
from loadwarden.llm.components import components
from loadwarden.llm.rows import ROW_ID, arrow_map, join_side, packed, pieces, stored, unpacked

WIDTH = 5
COORDINATES = 64
#: The least similarity of a link, as a fraction.
SIMILAR = (85, 100)
LIST_BLOCK = 512
SET_BLOCK = 256
_MIX = np.random.default_rng(11).integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64) | np.uint64(1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def least_matches(similar: tuple[int, int]) -> int:
    """Equal coordinates expected at this similarity, less five standard deviations: 40 at 0.85, 35 at 0.8."""
    share = similar[0] / similar[1]
    return max(1, math.floor(COORDINATES * share - 5 * math.sqrt(COORDINATES * share * (1 - share))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, with A-Z lowered, and where each text's words begin."""
    texts = texts.cast(pa.large_string()).fill_null("")
    low = texts
    if pc.any(pc.match_substring_regex(texts, "[A-Z]")).as_py():
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8).copy()
        upper = (data >= 65) & (data <= 90)
        data[upper] += 32
        low = pa.LargeStringArray.from_buffers(
            len(texts), texts.buffers()[1], pa.py_buffer(data), offset=texts.offset
        )
    parts = pc.split_pattern_regex(low, r"[\x20\x09-\x0D]+")
    words, owners = parts.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    real = pc.not_equal(words, "")
    owners = owners[real.to_numpy(zero_copy_only=False)]
    return words.filter(real), np.searchsorted(owners, np.arange(len(texts) + 1))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Sorted digests of all texts' sets, where each begins, and a digest of each text's words."""
    words, starts = _split(texts)
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    known = np.fromiter(
        (digest(w.encode()) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
    )
    hashes = known[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    sets, keys = [], []
    runs = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        runs = _mixed(runs + hashes[i : i + len(runs)] * _ODD[i % len(_ODD)])
    for a, b in zip(starts.tolist(), starts[1:].tolist()):
        n = b - a
        keys.append(hashlib.md5(hashes[a:b].tobytes()).digest() if n else None)
        if n >= width:
            sets.append(np.unique(runs[a : b - width + 1]))
        elif n:
            sets.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes())], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds, keys


def signatures(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The MinHash signature of each set that is not empty, as 32-bit values."""
    begins = bounds[:-1][np.diff(bounds) > 0]
    found = np.empty((len(begins), COORDINATES), np.uint32)
    if not len(begins):
        return found
    mixed = _mixed(flat)
    for k in range(COORDINATES):
        values = ((mixed * _MIX[0, k] + _MIX[1, k]) >> np.uint64(32)).astype(np.uint32)
        found[:, k] = np.minimum.reduceat(values, begins)
    return found


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, set size, digest of the words and signature of each document."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4 << 20):
            flat, bounds, keys = shingle_sets(batch.column("text"))
            data = iter(signatures(flat, bounds))
            sizes = np.diff(bounds)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes),
                pa.array(keys, pa.binary()),
                pa.array([next(data).tobytes() if n else None for n in sizes.tolist()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key", "signature"])

    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"),
        sign,
        "doc_id bigint, n_shingles bigint, key binary, signature binary",
    )


def _posted(classes: DataFrame, matches: int) -> DataFrame:
    """(posting, node): every class under those of its rarest values that others have as well."""
    prefix = COORDINATES - matches + 1
    value = F.conv(F.hex(F.expr("reverse(substring(signature, 4 * k + 1, 4))")), 16, 10).cast("long")
    postings = (
        classes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(COORDINATES - 1))).alias("k"))
        .select("node", (F.col("k").cast("long") * (1 << 32) + value).alias("posting"))
    )
    shared = postings.groupBy("posting").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = (
        # Spark takes the size of an exploded table for that of the rows before, and would broadcast it.
        postings.join(shared.hint("merge"), "posting")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "posting"))).alias("all"))
    )
    # Values of its own are the rarest, and the first of the prefix.
    least = F.lit(prefix - COORDINATES) + F.size("all")
    return own.where(least > 0).select("node", F.explode(F.slice("all", F.lit(1), least)).alias("x")).select(
        "node", F.col("x.posting").alias("posting")
    )



def candidates(classes: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Edges (a, b) that connect every pair of classes with ``least_matches`` equal coordinates or more."""
    posted = stored(_posted(classes.select("node", "signature"), least_matches(similar)), "posted")
    lists = posted.groupBy("posting").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(3), "node")).alias("y"),
    )
    once = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min("posting").alias("posting")).select("posting")
    marked = classes.select("node", "signature", "n_shingles")
    rows = posted.join(once.hint("merge"), "posting").join(join_side(marked), "node")
    paired = block_pairs(rows, "posting", "node", LIST_BLOCK)

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        nodes, own, sizes, marks = _columns(table)
        i, j = _pairs(own, sizes, marks, similar)
        merger = Merger(len(nodes))
        kept = [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())) if merger.join(x, y)]
        return _edges(nodes[i[kept]], nodes[j[kept]])

    return each_block_pair(
        paired, "posting", compare, "a bigint, b bigint", ["node", "n_shingles", "signature"]
    )


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    marks = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, COORDINATES)
    return table["node"].to_numpy(), table["_own"].to_numpy(), table["n_shingles"].to_numpy(), marks


def _pairs(
    own: np.ndarray, sizes: np.ndarray, marks: np.ndarray, similar: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs across the two blocks, or within the one, that agree and whose sizes allow a link.

    The most similar ones come first.
    """
    first = np.flatnonzero(own == own.min())
    second = np.flatnonzero(own == own.max())
    counts = np.zeros((len(first), len(second)), np.uint8)
    for k in range(COORDINATES):
        counts += marks[first, k][:, None] == marks[second, k][None, :]
    small = np.minimum(sizes[first][:, None], sizes[second][None, :])
    large = np.maximum(sizes[first][:, None], sizes[second][None, :])
    fits = (counts >= least_matches(similar)) & (similar[1] * small >= similar[0] * large)
    if own.min() == own.max():
        fits = np.triu(fits, 1)
    i, j = np.nonzero(fits)
    order = np.argsort(-counts[i, j].astype(np.int16), kind="stable")
    return first[i[order]], second[j[order]]


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
    if not len(a):
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a)), pa.array(np.asarray(b))], ["a", "b"])


def confirmed(docs: DataFrame, classes: DataFrame, groups: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) between classes, confirmed on their full sets; enough to connect what is linked.

    ``groups`` has the candidates as (node, component); a link needs ``similar[1]`` times the
    common digests to be at least ``similar[0]`` times those of either set.
    """
    members = classes.join(join_side(groups), "node").select("node", "key", "signature", "component")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "component", "signature", "n_shingles", "digests"]
        for batch in pieces(batches, 4 << 20):
            flat, bounds, keys = shingle_sets(batch.column("text"))
            same = pc.equal(pa.array(keys, pa.binary()), batch.column("key")).fill_null(False)
            data = [flat[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            columns = [
                *(batch.column(c) for c in names[:3]),
                pa.array(np.diff(bounds)),
                pa.array(data, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names).filter(same)

    # Of rows with the same doc_id those with other words drop out by the key.
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(members.hint("merge"), "node")
    rows = arrow_map(
        texts.select("node", "component", "signature", "key", "text"),
        sets,
        "node bigint, component bigint, signature binary, n_shingles bigint, digests binary",
    )
    rows = stored(rows, "sets")

    def link(table: pa.Table) -> pa.RecordBatch | None:
        nodes, own, sizes, marks = _columns(table)
        digests = [np.frombuffer(x, np.uint64) for x in table["digests"].to_pylist()]
        merger, kept = Merger(len(nodes)), []
        i, j = _pairs(own, sizes, marks, similar)
        for x, y in zip(i.tolist(), j.tolist()):
            if merger.find(x) == merger.find(y):
                continue
            common = len(np.intersect1d(digests[x], digests[y], assume_unique=True))
            if similar[1] * common >= similar[0] * (sizes[x] + sizes[y] - common):
                merger.join(x, y)
                kept.append((x, y))
        if not kept:
            return None
        a, b = np.array(kept).T
        return _edges(nodes[a], nodes[b])

    return each_block_pair(
        block_pairs(rows, "component", "node", SET_BLOCK),
        "component",
        link,
        "a bigint, b bigint",
        ["node", "n_shingles", "signature", "digests"],
    )


def near_duplicates(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document, linked at ``similar`` or more."""
    rows = stored(signed(docs), "signed")
    with_set = rows.where("n_shingles > 0")
    classes = stored(
        with_set.groupBy("key")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .where("node is not null"),
        "classes",
    )
    groups = components(candidates(classes, similar))
    links = confirmed(docs, classes, groups, similar)
    # Documents of a class are linked with its first one, also if their doc_id has other rows.
    copies = with_set.select("doc_id", "key").join(join_side(classes.select("key", "node")), "key")
    edges = links.union(copies.where("doc_id <> node").select("doc_id", "node"))
    found = components(edges)
    return rows.join(join_side(found), F.col("doc_id") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        _kept().alias("kept"),
    )


def _kept() -> Column:
    return F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True))


def drop_near_duplicates(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The documents, unchanged, of which no near-duplicate that comes first is linked.

    Rows are the nodes here, so that of equal texts one stays also where doc_ids are null or
    repeat. The smallest doc_id comes first, null last, and among equal ones the first row.
    """
    kept = stored(packed(docs), "rows", "zstd")
    found = near_duplicates(kept.select(F.col(ROW_ID).alias("doc_id"), F.col("doc.text").alias("text")), similar)
    rank = F.struct(F.col("id").isNull().alias("none"), "id", ROW_ID)
    ids = kept.select(ROW_ID, F.col("doc.doc_id").alias("id"))
    n_rows = kept.count()
    of_row = stored(
        found.select(F.col("doc_id").alias(ROW_ID), "component_id").join(join_side(ids, n_rows), ROW_ID), "of_row"
    )
    first = of_row.groupBy("component_id").agg(F.min(rank).alias("first")).select(F.col(f"first.{ROW_ID}").alias(ROW_ID))
    gone = stored(of_row.select(ROW_ID).join(join_side(first, n_rows), ROW_ID, "left_anti"), "gone")
    return unpacked(kept.join(join_side(gone), ROW_ID, "left_anti"), docs)
