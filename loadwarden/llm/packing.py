"""Packing documents into sequences of equal estimated cost and next to no padding.

A sequence costs a linear part per token and a quadratic part per document
piece in it, as attention does within a document. Documents of at least a full
sequence give whole sequences first. What is left of a block of documents is
assigned by descending length, each piece to the lowest-cost sequence that has
room for it. The block has just as many sequences as its tokens fill; the rest
below a full one becomes sequences of power-of-two lengths, which need no
padding. A piece that fits nowhere is cut, so that all sequences are full.

Blocks are packed where they are read: nothing is shuffled, and a task holds
one block, or one document if that is larger. Sequence numbers are built from
the number of the partition, the block and the sequence, and gapless in none;
a task that runs again gives the same ones.

Cases: a null or empty text is its end id alone; null and repeated doc_ids are
documents like any other; without documents there are no sequences; columns
besides doc_id and text play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from loadwarden.llm.rows import arrow_map, pieces
from loadwarden.llm.tokens import WORDS_KEPT, loaded, with_end

CAPACITY = 2048
BLOCK_TOKENS = 1 << 20
#: Cost of a token, and of a token attending to another: their ratio at a model width of 1,024.
LINEAR, QUADRATIC = 1.0, 1 / 6144


def pack_lengths(
    lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset), ordered by sequence and offset."""
    pieces_of: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for i in np.flatnonzero(lengths >= capacity).tolist():
        for start in range(0, int(lengths[i]) // capacity * capacity, capacity):
            pieces_of.append((i, start, capacity, sequence, 0))
            sequence += 1
    rest = lengths % capacity
    total = int(rest.sum())
    tail = [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
    room = np.array([capacity] * (total // capacity) + tail, dtype=np.int64)
    used, cost = np.zeros_like(room), np.zeros(len(room))
    queue = [(-int(n), i, int(lengths[i] - n)) for i, n in enumerate(rest.tolist()) if n]
    heapq.heapify(queue)
    while queue:
        minus, i, start = heapq.heappop(queue)
        length = -minus
        fits = room >= length
        k = int(np.where(fits, cost, np.inf).argmin())
        if not fits[k]:  # nowhere as a whole: fill the sequence with the most room, the rest queues again
            k = int(room.argmax())
            cut = int(room[k])
            heapq.heappush(queue, (cut - length, i, start + cut))
            length = cut
        pieces_of.append((i, start, length, sequence + k, int(used[k])))
        used[k] += length
        room[k] -= length
        cost[k] += linear * length + quadratic * length * length
    return sorted(pieces_of, key=lambda p: (p[3], p[4]))


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int = 1,
    capacity: int = CAPACITY,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    words_kept: int = WORDS_KEPT,
    piece_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian unsigned 32-bit integers.

    ``words_kept`` pieces of text that a worker remembers, and ``piece_bytes`` of text that it encodes
    at once, trade its memory for time; ids are the same with any.
    """
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def packed(doc_ids: list[pa.Array], parts: list[np.ndarray], sizes: list[np.ndarray], first: int):
        ids, lengths = np.concatenate(parts), np.concatenate(sizes)
        starts = np.cumsum(lengths) - lengths
        rows = np.array(pack_lengths(lengths, capacity, linear, quadratic), dtype=np.int64)
        doc, start, length, sequence, offset = rows.T
        keys = pa.concat_arrays(doc_ids).take(pa.array(doc))
        for a in range(0, len(rows), 4096):
            s = slice(a, a + 4096)
            data = [
                ids[p : p + n].astype("<u4").tobytes()
                for p, n in zip((starts[doc[s]] + start[s]).tolist(), length[s].tolist())
            ]
            columns = [
                keys.slice(a, 4096),
                pa.array(start[s]),
                pa.array(length[s]),
                pa.array(data, pa.binary()),
                pa.array(lengths[doc[s]]),
                pa.array(first + sequence[s]),
                pa.array(offset[s]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(tokenizer_path, words_kept)
        number = TaskContext.get().partitionId() << 40
        doc_ids, parts, sizes, held = [], [], [], 0
        for batch in pieces(batches, piece_bytes):
            ids, bounds = with_end(*tokenizer.encode(batch.column("text")), end_id)
            doc_ids.append(batch.column("doc_id"))
            parts.append(ids)
            sizes.append(np.diff(bounds))
            held += len(ids)
            if held >= block_tokens:
                yield from packed(doc_ids, parts, sizes, number)
                number += 1 << 20 if held < capacity << 19 else held // capacity + (1 << 20)
                doc_ids, parts, sizes, held = [], [], [], 0
        if held:
            yield from packed(doc_ids, parts, sizes, number)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        docs.select("doc_id", "text"),
        pack,
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )
