"""Conversations as token ids of a chat template, with loss masks, and back again.

A turn is ``<turn>`` role ``<says>`` text ``</turn>``. The segments, role and text, are encoded
on their own, and the three marks are ids after the tokenizer's vocabulary, spliced
in between: no text can give such an id. Lengths of the segments, summed up, give the
place of every id, and so the loss mask, which covers the texts of the roles to be learned.

In texts and roles a mark's own string is escaped, so that the formatted text can be read
as well: before it, and at the end of a segment, every backslash is doubled, and one more
stands before the mark. Escaping is undone exactly.

Turns are dealt by ranges of conversation and turn, so a conversation of any length
is spread over many tasks; places in a conversation are put together from those in its parts.

Cases: turns go by their number, null first, and equal numbers by a digest of role and
text; a null role or text is empty; repeated rows are turns like others; rows
without a conv_id are one conversation, without an id; no rows give no rows; other columns
play no part. Texts may hold any character, zero characters included.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadwarden.llm.rows import arrow_map, kept_in_stage, pieces, stored
from loadwarden.llm.tokens import loaded
from loadwarden.llm.turns import AT, PART, Runs, earlier, in_order, placed_over_parts, segments, turn_rows

#: The marks: before a turn, between its role and its text, and after it. Their ids follow the vocabulary in this order.
MARKS = ("<turn>", "<says>", "</turn>")
LEARNED = ("assistant",)
#: Bytes of text that are formatted, or read back, at once.
PIECE = 1 << 20

_ANY_MARK = "|".join(map(re.escape, MARKS))
_ESCAPED = re.compile(rf"\\(\\*)({_ANY_MARK})|(\\+)\Z")


def escape(texts: pa.Array) -> pa.Array:
    """Texts in which no mark stands by itself, and no backslash before a mark or the end is single."""
    marked = pc.replace_substring_regex(texts, rf"(\\*)({_ANY_MARK})", r"\1\1\\\2")
    return pc.replace_substring_regex(marked, r"(\\+)\z", r"\1\1")


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""

    def single(found: re.Match[str]) -> str:
        if found[3] is not None:
            return found[3][::2]
        return found[1][::2] + found[2]

    return _ESCAPED.sub(single, text) if "\\" in text else text


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, learned: Sequence[str] = LEARNED
) -> DataFrame:
    """A row per turn: its ids, and where they and those under the loss mask are in its conversation.

    (conv_id, at, ids, start, length, loss_start, loss_length): ``at`` counts turns from 0, ``ids``
    are little-endian unsigned 32-bit integers, and the others count ids; starts are from the
    conversation's first id on. The loss is on the text alone; its length is 0 in other turns.
    """
    learned = list(learned)

    def form(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(tokenizer_path)
        marks = tokenizer.vocabulary + np.arange(len(MARKS), dtype=np.uint32)
        runs, part = Runs(), TaskContext.get().partitionId()
        for batch in pieces(batches, PIECE):
            if not batch.num_rows:
                continue
            n = batch.num_rows
            roles, texts = batch.column("role"), batch.column("text")
            segments_of = [tokenizer.encode(escape(column)) for column in (roles, texts)]
            sizes = np.ones((n, 5), np.int64)  # mark, role, mark, text, mark
            for k, (_, bounds) in zip((1, 3), segments_of):
                sizes[:, k] = np.diff(bounds)
            ends = np.cumsum(sizes.reshape(-1)).reshape(n, 5)
            starts = ends - sizes
            ids = np.empty(ends[-1, -1], np.uint32)
            for k, mark in zip((0, 2, 4), marks):
                ids[starts[:, k]] = mark
            for k, (of_segment, _) in zip((1, 3), segments_of):
                ids[_covered(starts[:, k], sizes[:, k])] = of_segment
            length = ends[:, -1] - starts[:, 0]
            at, before = runs.place(batch.column("conv_id"), length)
            learns = pc.is_in(roles, pa.array(learned, roles.type)).to_numpy(zero_copy_only=False)
            data = ids.astype("<u4").tobytes()
            offsets = np.concatenate((starts[:, 0], ends[-1:, -1])) * 4
            columns = [
                batch.column("conv_id"),
                pa.array([part] * n, pa.int64()),
                pa.array(at),
                pa.array([data[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())], pa.binary()),
                pa.array(before),
                pa.array(length),
                pa.array(before + starts[:, 3] - starts[:, 0]),
                pa.array(np.where(learns, sizes[:, 3], 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["conv_id", PART, AT, "ids", "start", "length", "loss_start", "loss_length"]
    schema = f"conv_id bigint, {PART} bigint, {AT} bigint, ids binary, start bigint, length bigint, loss_start bigint, loss_length bigint"
    placed = stored(arrow_map(in_order(turn_rows(conversations)), form, schema), "formatted")
    of_parts = segments(placed, F.sum("length").alias("_length"))
    of_parts = earlier(of_parts, _turns_before="n", _ids_before="_length")
    whole = placed_over_parts(
        placed, of_parts.withColumn("_loss_before", F.col("_ids_before")),
        **{AT: "_turns_before", "start": "_ids_before", "loss_start": "_loss_before"},
    )
    return whole.select("conv_id", F.col(AT).alias("at"), *names[3:])


def _covered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all segments, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def token_bytes(tokenizer_path: str) -> tuple[int, np.ndarray, np.ndarray]:
    """How many ids a byte-level vocabulary has, the bytes of all of them, and where each one's start.

    In such a vocabulary a character stands for a byte: printable ones of Latin-1 for their own,
    those from 256 on for the other bytes in their order.
    """
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab()
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in own}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(own))}
    tokens = sorted(vocabulary, key=vocabulary.get)
    if sorted(vocabulary.values()) != list(range(len(tokens))) or any(c not in byte_of for t in tokens for c in t):
        raise ValueError(f"{tokenizer_path} is no byte-level vocabulary without gaps")
    data = np.array([byte_of[c] for t in tokens for c in t], np.uint8)
    return len(tokens), data, np.concatenate(([0], np.cumsum([len(t) for t in tokens])))


def read_turns(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """The turns from their ids: (conv_id, at, role, text, loss, formatted_chars).

    ``loss`` is what the ids under the mask say, without escapes, null where there are none;
    ``formatted_chars`` are the code points of the formatted turn, marks and escapes included.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, data, offsets = kept_in_stage(("bytes", tokenizer_path), lambda: token_bytes(tokenizer_path))
        sizes_of = np.diff(offsets)
        mark_chars = sum(map(len, MARKS))
        for batch in pieces(batches, PIECE):
            rows = [np.frombuffer(ids, "<u4") for ids in batch.column("ids").to_pylist()]
            if not rows:
                continue
            ids = np.concatenate(rows).astype(np.int64)
            ends = np.cumsum([len(row) for row in rows])
            marks = np.flatnonzero(ids >= first)
            if (ids[marks] - first != np.arange(len(marks)) % len(MARKS)).any() or len(marks) != 3 * len(rows):
                raise ValueError("a turn does not have its three marks")
            marks = marks.reshape(-1, 3)
            if (marks[:, 2] != ends - 1).any() or (marks[:, 0] != np.concatenate(([0], ends[:-1]))).any():
                raise ValueError("a turn does not begin and end with its marks")
            loss, loss_start, start = (batch.column(c).to_numpy() for c in ("loss_length", "loss_start", "start"))
            begin = marks[:, 0] + loss_start - start
            # What the mask covers is a text, so that each is decoded once.
            if ((loss > 0) & ((begin != marks[:, 1] + 1) | (begin + loss != marks[:, 2]))).any():
                raise ValueError("the loss mask does not cover a text")
            sizes = np.where(ids < first, sizes_of[np.minimum(ids, first - 1)], 0)
            said = data[_covered(offsets[np.minimum(ids, first - 1)], sizes)].tobytes()
            at = np.concatenate(([0], np.cumsum(sizes)))
            roles, texts = (
                [said[a:b].decode() for a, b in zip(at[marks[:, k]].tolist(), at[marks[:, k + 1]].tolist())] for k in (0, 1)
            )
            plain = [unescape(t) for t in texts]
            text = pa.string()
            columns = [
                batch.column("conv_id"),
                batch.column("at"),
                pa.array(map(unescape, roles), text),
                pa.array(plain, text),
                pa.array([t if m else None for t, m in zip(plain, (loss > 0).tolist())], text),
                pa.array([len(r) + len(t) + mark_chars for r, t in zip(roles, texts)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "at", "role", "text", "loss", "formatted_chars"])

    schema = "conv_id bigint, at bigint, role string, text string, loss string, formatted_chars bigint"
    return arrow_map(formatted.drop("length"), read, schema)


class _Digest:
    """What is said about a conversation, turn by turn."""

    def __init__(self, conv_id: int | None, at: int):
        self.conv_id, self.first, self.n = conv_id, at, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0

    def add(self, role: str, text: str, loss: str | None, chars: int) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update((loss or "").encode())
        self.loss_chars += len(loss or "")
        self.chars += chars

    def row(self) -> tuple:
        return (self.conv_id, self.first, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGEST = "conv_id bigint, first bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _digested(turns: DataFrame) -> DataFrame:
    """A row per run of turns that follow each other in a task."""
    names = [column.split()[0] for column in _DIGEST.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for conv_id, at, *said in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or (conv_id, at) != (now.conv_id, now.first + now.n):
                    if now is not None:
                        rows.append(now.row())
                    now = _Digest(conv_id, at)
                now.add(*said)
            if len(rows) >= 4096:
                yield made(rows)
                rows = []
        if now is not None:
            yield made([*rows, now.row()])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    return arrow_map(turns, run, _DIGEST)


def read_digests(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation its turns, digests of them and of the text under the loss mask, and code points.

    The turns lie in order, so nearly all conversations are whole within a task, and their texts
    are not shuffled. That is not taken on trust: a conversation whose runs do not have all its
    turns, as where two tasks share it, is dealt by its id, sorted and read again.
    """
    turns = read_turns(formatted, tokenizer_path)
    counts = formatted.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumnRenamed("conv_id", "_conv")
    runs = stored(_digested(turns), "digests")
    known = runs.join(counts, F.col("conv_id").eqNullSafe(F.col("_conv")))
    whole = (F.col("first") == 0) & (F.col("n_turns") == F.col("_n"))
    cut = known.where(~whole).select("_conv").distinct()
    of_cut = formatted.join(cut, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    dealt = read_turns(of_cut, tokenizer_path)
    again = _digested(dealt.repartition("conv_id").sortWithinPartitions("conv_id", "at"))
    return known.where(whole).drop("_conv", "_n").union(again).drop("first")
