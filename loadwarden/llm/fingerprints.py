"""Document fingerprints by bucket quartiles.

Hashed byte triplets of a text are counted in buckets. A bucket's digit tells
in which quarter of all buckets' counts its own count lies, and the length of
the text is kept on a logarithmic scale. Texts that share most of their bytes
have most digits in common, wherever they differ. The difference of two
fingerprints adds up the digits' distances, one across the whole range counting
double, and the steps between the lengths, up to a bound; a likeness of 1 means
equal fingerprints, 0 no more alike than unrelated texts.

``fingerprint_neighbours`` compares each document with the next one in
descending order of doc_id. Documents are dealt to tasks in ranges of that order, which
splits rows with equal or null ids as well, and each task streams through its own; only the last
document of a range needs the first one of another, so one text per range is passed on, by the other's number.

Cases: a null text is empty; texts below three bytes have no triplets; null
doc_ids come last and rows with equal doc_ids are ordered by the first characters of their texts, then
by a hash of them; the only document is its own neighbour; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rows import ROW_ID, arrow_map, row_id, stored

BUCKETS = 256
LENGTH_STEP = 1.1
MOST_LENGTH = 32
#: A distance of 0, 1, 2 or 3 quarters counts this much; unrelated digits differ by 1.625 on average.
_COSTS = np.array([0, 1, 2, 6])
_UNRELATED = 1.625 * BUCKETS
ROWS_PER_RANGE = 20_000


def fingerprint(text: str | None) -> str:
    """Two hexadecimal digits of length, then two bits for each bucket."""
    data = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    if len(data) > 2:
        code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
        code = (code + np.uint32(0x7F4A7C15)) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        counts = np.bincount((code * np.uint32(0x85EBCA77)) >> np.uint32(24), minlength=BUCKETS)
    quarters = np.sort(counts)[[BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4]]
    digits = (counts[:, None] > quarters[None, :]).sum(axis=1).astype(np.uint8)
    packed = digits[0::4] << 6 | digits[1::4] << 4 | digits[2::4] << 2 | digits[3::4]
    length = min(255, round(np.log(len(data) + 1) / np.log(LENGTH_STEP)))
    return f"{length:02x}{packed.tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    length = min(abs(int(x[0]) - int(y[0])), MOST_LENGTH)
    shifts = np.array([6, 4, 2, 0], np.uint8)
    apart = np.abs(
        (x[1:, None] >> shifts & 3).astype(np.int16) - (y[1:, None] >> shifts & 3).astype(np.int16)
    )
    return max(0.0, 1.0 - (float(_COSTS[apart].sum()) + length) / _UNRELATED)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = (
    "doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def _compared(doc_id, text: str, mark: str, following: str, following_mark: str) -> tuple:
    changed = edited(text, following)
    changed_mark = fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        mark,
        changed_mark,
        likeness(mark, changed_mark),
        likeness(mark, following_mark),
    )


def in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id and text in descending order of doc_id, in ranges of about as many rows each.

    Where ids are equal or null, the row number is the last part of the order: a third of all rows
    with one id, or with one text, is more than one range.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("head"), F.col("hash"), F.col(ROW_ID)]
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select("doc_id", text.alias("text"), F.substring(text, 1, 16).alias("head"), F.xxhash64(text).alias("hash"), row_id().alias(ROW_ID))
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )


def fingerprint_neighbours(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like it and the next document are."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = _RESULT.format(kind=kind)
    names = [c.split()[0] for c in result.split(", ")]
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    ranges = max(2 * parallel, -(-docs.count() // rows_per_range))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of all rows but the range's last, which goes on with its text, as does the first."""
        part, before, first = TaskContext.get().partitionId(), None, None
        key_type = None
        for batch in batches:
            key_type = batch.column("doc_id").type
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                now = (doc_id, text, fingerprint(text))
                if before is None:
                    first = now
                else:
                    rows.append(_compared(*before, *now[1:]))
                before = now
            if rows:
                yield _batch(rows, names, key_type, part)
        if before is not None:
            yield _ends([first, before], names, key_type, part)

    columns = f"{result}, part bigint, role string, text string"
    done = stored(arrow_map(in_order(docs, ranges), compare, columns), "fingerprints")
    # A row per range: its last document, and the first one of the range after it, or of the first range.
    firsts = done.where("role = 'first'").select("part", "text", "fingerprint")
    lasts = done.where("role = 'last'").select("part", "doc_id", F.col("text").alias("own"), F.col("fingerprint").alias("mark"))
    order = W.orderBy("part")
    # Numbers alone go through the window of all ranges; texts are joined to them.
    numbers = firsts.select("part")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turns = numbers.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(whole)).alias("after"))
    following = firsts.select(F.col("part").alias("after"), "text", F.col("fingerprint").alias("next"))
    paired = lasts.join(turns, "part").join(following, "after").select("doc_id", "own", "mark", "text", "next")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_compared(*row.values()) for row in batch.to_pylist()]
            if rows:
                yield _batch(rows, names, batch.column(0).type)

    return done.where("role is null").select(*names).union(arrow_map(paired, finish, result))


def _batch(rows: list[tuple], names: list[str], key_type: pa.DataType, part: int | None = None) -> pa.RecordBatch:
    doc_id, n_chars, *rest = zip(*rows)
    columns = [pa.array(doc_id, key_type), pa.array(n_chars, pa.int64()), *map(pa.array, rest)]
    if part is None:
        return pa.RecordBatch.from_arrays(columns, names)
    empty = pa.nulls(len(rows), pa.string())
    columns += [pa.array([part] * len(rows), pa.int64()), empty, empty]
    return pa.RecordBatch.from_arrays(columns, [*names, "part", "role", "text"])


def _ends(ends: list[tuple], names: list[str], key_type: pa.DataType, part: int) -> pa.RecordBatch:
    (doc_ids, texts, marks), n = zip(*ends), len(ends)
    text, number = pa.string(), pa.float64()
    columns = [
        pa.array(doc_ids, key_type),
        pa.nulls(n, pa.int64()),
        pa.nulls(n, text),
        pa.array(marks, text),
        pa.nulls(n, text),
        pa.nulls(n, number),
        pa.nulls(n, number),
        pa.array([part] * n, pa.int64()),
        pa.array(["first", "last"], text),
        pa.array(texts, text),
    ]
    return pa.RecordBatch.from_arrays(columns, [*names, "part", "role", "text"])
