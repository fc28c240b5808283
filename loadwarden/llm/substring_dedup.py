"""Removal of passages that repeat across documents, by hashed units.

Units are the sentences of each line. A unit is normalised (lower case, words
alone, single blanks) and stands under its digest; over all documents the
earliest occurrence of a digest, by doc_id and place, is kept and every other
one is a repeat. Repeats next to each other make up a run, and runs with at
least ``least_words`` words are removed: a passage goes whose sentences occurred
before, wherever it stands in its line, while single common phrases stay. With
``whole_lines`` a line that repeats an earlier whole line goes as well, however
short it is. In a sentence so long that a passage of its own may be a part of it,
windows of words are hashed as well, which begin and end at places that the words
around them set; repeated ones go. Kept text keeps its own characters, and removed ranges are given by original offsets.

Units are shuffled by digest once, and their counts and first occurrences are taken in
a window there. Digests that make up a good part of all units are found beforehand, by lossy
counting in every task, and not shuffled: they are counted map-side, and as at most
some thousands they are broadcast to their units. Units of one document only meet in a
window. The digests have 128 bits.

Cases: null and empty texts have no units; units without a letter or digit are
no units, and neither repeat nor part a run; Chinese and Japanese letters count as a
word each, and sentences there end without a blank; repeats inside one document count;
null doc_ids rank last, and among rows with equal doc_ids the order is that of
the scan; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rows import ROW_ID, arrow_map, packed, pieces, row_id, stored, unpacked

LEAST_WORDS = 20
#: Kinds of hashed parts: a sentence among others of its line, one that is its line, and a line of several.
UNIT, WHOLE, LINE, WINDOW = 0, 1, 2, 3
#: Windows begin where one of CUT successive runs of CUT_WORDS words has the least digest: nowhere further apart.
CUT, CUT_WORDS = 6, 3
#: So many words more than the least length a sentence, or a passage in one, needs for windows.
MARGIN = 30
#: A digest of more than a HOT_SHARE-th of a task's units is hot if that is half as much of all units.
HOT_SHARE = 1000
#: A run of marks is tried at its beginning alone: within it, nothing else can end.
_UNIT = re.compile(r"[^\n]*?(?:(?<![.!?…])[.!?…]+[\"')\]»”]*(?=\s)|(?=\n)|\Z)")
_WORDS = re.compile(r"[^\W_]+")
#: Letters of scripts without blanks. Each counts as a word, and their sentences end without a blank.
_HAN = "\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_ANY_HAN = re.compile(f"[{_HAN}。！？｡]")
_HAN_UNIT = re.compile(
    r"[^\n]*?(?:[。！？｡]+[.!?…。！？｡]*[\"')\]»”’」』）】]*|(?<![.!?…])[.!?…]+[\"')\]»”]*(?=\s)|(?=\n)|\Z)"
)
_HAN_WORDS = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")


def _patterns(text: str) -> tuple[re.Pattern, re.Pattern]:
    """What finds the units and the words of this text."""
    return (_HAN_UNIT, _HAN_WORDS) if not text.isascii() and _ANY_HAN.search(text) else (_UNIT, _WORDS)


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()


def units(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of each unit; code points, end exclusive."""
    found = []
    unit, word = _patterns(text)
    for match in unit.finditer(text):
        words = word.findall(match.group().lower())
        if words:
            start = match.end() - len(match.group().lstrip())
            found.append((start, match.end(), len(words), _digest(words)))
    return found


def _windows(text: str, start: int, end: int, word: re.Pattern, least_words: int) -> list[tuple]:
    """(at, start, end, words, digest) of windows of ``least_words`` words and some more in a long sentence.

    Where they begin and end depends on the words around alone, so a passage of
    ``least_words + MARGIN`` words has a window that is the same in every copy, and at most
    10 words at its start and 13 at its end are in none.
    """
    found = list(word.finditer(text, start, end))
    words = [m.group().lower() for m in found]
    runs = np.fromiter(
        (xxhash.xxh3_64_intdigest(" ".join(words[i : i + CUT_WORDS])) for i in range(len(words) - CUT_WORDS + 1)),
        np.uint64,
    )
    least = np.lib.stride_tricks.sliding_window_view(runs, CUT).argmin(axis=1)
    cuts = np.unique(np.arange(len(least)) + least)
    ends = np.searchsorted(cuts, cuts + least_words)
    windows = []
    for a, k in zip(cuts.tolist(), ends.tolist()):
        if k < len(cuts):
            b = int(cuts[k])
            windows.append((a, found[a].start(), found[b - 1].end(), b - a, _digest(["", *words[a:b]])))
    return windows


def _lines(text: str, found: list[tuple]) -> list[int]:
    """The number of each unit's line."""
    numbers, line, last = [], 0, 0
    for start, *_ in found:
        line += text.count("\n", last, start)
        last = start
        numbers.append(line)
    return numbers


def _parts(text: str, least_words: int, whole_lines: bool) -> list[tuple]:
    """(kind, unit, line, at, start, end, words, digest) of the units, of lines of several ones, and of windows."""
    found, word = units(text), _patterns(text)[1]
    lines = _lines(text, found) if whole_lines else [0] * len(found)
    parts = [(UNIT, k, line, 0, *u) for k, (line, u) in enumerate(zip(lines, found))]
    if whole_lines:
        for line, group in groupby(range(len(found)), lines.__getitem__):
            of_line = list(group)
            first, last = of_line[0], of_line[-1]
            if first == last:
                parts[first] = (WHOLE, *parts[first][1:])
                continue
            start, end = found[first][0], found[last][1]
            words = word.findall(text[start:end].lower())
            parts.append((LINE, first, line, 0, start, end, len(words), _digest(words)))
    for k, (start, end, n_words, _) in enumerate(found):
        if n_words >= least_words + MARGIN:
            parts += [(WINDOW, k, lines[k], *w) for w in _windows(text, start, end, word, least_words)]
    return parts


def hashed_units(rows: DataFrame, least_words: int = LEAST_WORDS, whole_lines: bool = False) -> DataFrame:
    """A row per unit, window, and line if asked for, of rows with a row number, doc_id and text.

    ``unit`` counts within the text; a line has the number of its first unit. A window begins
    at word ``at`` of its unit.
    """
    names = ["kind", "unit", "line", "at", "start", "end", "words", "digest"]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2 << 20):
            found = [_parts(t, least_words, whole_lines) if t else [] for t in batch.column("text").to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(u) for u in found]).astype(np.int64))
            flat = [u for of_text in found for u in of_text]
            values = zip(*flat) if flat else [()] * len(names)
            columns = [
                batch.column(ROW_ID).take(owner),
                batch.column("doc_id").take(owner),
                *(pa.array(v, pa.binary() if n == "digest" else pa.int32()) for n, v in zip(names, values)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [ROW_ID, "doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        rows.select(ROW_ID, "doc_id", "text"),
        split,
        f"{ROW_ID} bigint, doc_id {kind}, kind int, unit int, line int, at int, start int, end int, words int, digest binary",
    )


def hot_digests(found: DataFrame) -> DataFrame:
    """Digests that many units have: all with two in HOT_SHARE of them, and at most 2 * HOT_SHARE digests.

    Counting forgets, after each batch, digests met no more often than there were batches since;
    what is left of a task's counts is too low by a row per batch at most.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, list[int]] = {}
        total = 0
        for bucket, batch in enumerate(batches, 1):
            total += batch.num_rows
            values, counts = pc.value_counts(batch.column("digest")).flatten()
            # What is met once here, and is not known yet, would be forgotten at once.
            lasts = pc.greater(counts, 1)
            if met:
                lasts = pc.or_(lasts, pc.is_in(values, pa.array(list(met), pa.binary())))
            for digest, n in zip(values.filter(lasts).to_pylist(), counts.filter(lasts).to_pylist()):
                met.setdefault(digest, [0, bucket - 1])[0] += n
            met = {d: e for d, e in met.items() if sum(e) > bucket}
        most = [(d, n) for d, (n, missed) in met.items() if (n + missed) * HOT_SHARE >= total]
        columns = [pa.array([d for d, _ in most], pa.binary()), pa.array([n for _, n in most], pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([0] * len(most), pa.int64())], ["digest", "n", "total"])
        last = [pa.nulls(1, pa.binary()), pa.array([0], pa.int64()), pa.array([total], pa.int64())]
        yield pa.RecordBatch.from_arrays(last, ["digest", "n", "total"])

    counted = stored(arrow_map(found.select("digest"), count, "digest binary, n bigint, total bigint"), "hot")
    total = counted.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    of_digest = counted.where("digest is not null").groupBy("digest").agg(F.sum("n").alias("n"))
    return of_digest.where(F.col("n") * (2 * HOT_SHARE) >= total).select("digest")


def _repeats(rows: DataFrame, least_words: int, whole_lines: bool) -> DataFrame:
    """The units, and whole lines, of rows that go, each with the occurrence that is kept in its place."""
    found = stored(hashed_units(rows, least_words, whole_lines), "units")
    rank = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), ROW_ID, "unit", "start", "at"
    )
    of_line = F.col("kind").isin(LINE, WHOLE)
    # A line is held against earlier whole lines, also where one sentence is all of it.
    first_line = F.min(F.when(of_line, rank))
    hot = F.broadcast(stored(hot_digests(found), "hot_digests"))
    of_hot = (
        found.join(hot, "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(rank).alias("first"), first_line.alias("first_line"))
    )
    same = W.partitionBy("digest")
    others = (
        found.join(hot, "digest", "left_anti")
        .withColumn("_n", F.count(F.lit(1)).over(same))
        .withColumn("first", F.min(rank).over(same))
        .withColumn("first_line", first_line.over(same))
    )
    counted = found.join(F.broadcast(of_hot.withColumnRenamed("digest", "_digest")), F.col("digest") == F.col("_digest"))
    counted = counted.select(*others.columns).union(others)

    def later(than: str) -> Column:
        return (
            (F.col(ROW_ID) != F.col(f"{than}.{ROW_ID}"))
            | (F.col("unit") != F.col(f"{than}.unit"))
            | (F.col("start") != F.col(f"{than}.start"))
        )

    again = counted.where(F.col("_n") > 1).where(later("first"))
    is_unit = F.col("kind").isin(UNIT, WHOLE)
    in_order = W.partitionBy(ROW_ID).orderBy("unit", "kind", "start")
    n_units = F.sum(is_unit.cast("int")).over(in_order)
    n_words = F.sum(F.when(is_unit, F.col("words"))).over(W.partitionBy(ROW_ID, "_run"))
    line_goes = F.max(of_line & later("first_line")).over(W.partitionBy(ROW_ID, "line"))
    is_window = F.col("kind") == WINDOW
    # A line that goes is one row, in place of its units; windows go where their sentence stays.
    unit_goes = is_unit & (F.col("_words") >= least_words)
    goes = F.when(F.col("_line"), of_line).otherwise(unit_goes | (is_window & ~F.col("_sentence")))
    # A window that laps over the occurrence that is kept would take some of it away.
    same_unit = (F.col(ROW_ID) == F.col(f"first.{ROW_ID}")) & (F.col("unit") == F.col("first.unit"))
    laps = is_window & same_unit & (F.col("at") < F.col("first.at") + F.col("words"))
    # Of windows that overlap each one ends where the next begins.
    of_sentence = W.partitionBy(ROW_ID, "unit", "kind").orderBy("start")
    next_at, next_start = (F.when(is_window, F.lead(c).over(of_sentence)) for c in ("at", "start"))
    return (
        again.withColumn("_run", F.col("unit") - n_units)
        .withColumn("_words", n_words)
        .withColumn("_line", F.coalesce(line_goes, F.lit(False)) if whole_lines else F.lit(False))
        .withColumn("_sentence", F.coalesce(F.max(unit_goes).over(W.partitionBy(ROW_ID, "unit")), F.lit(False)))
        .where(goes & ~laps)
        .withColumn("_next_start", next_start)
        .withColumn("words", F.least("words", next_at - F.col("at")))
        .withColumn("end", F.least("end", "_next_start"))
        .select(
            ROW_ID,
            "doc_id",
            "unit",
            "start",
            "end",
            "words",
            F.when(F.col("_line"), F.col("first_line.doc_id")).otherwise(F.col("first.doc_id")).alias("first_doc_id"),
            F.when(F.col("_line"), F.col("first_line.start")).otherwise(F.col("first.start")).alias("first_start"),
        )
    )


def find_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, whole_lines: bool = False) -> DataFrame:
    """The units to remove: doc_id, place in the text, and where the kept occurrence is."""
    rows = docs.select(row_id().alias(ROW_ID), "doc_id", "text")
    return _repeats(rows, least_words, whole_lines).drop(ROW_ID)


def remove_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, whole_lines: bool = False) -> DataFrame:
    """The documents without the repeats, and ``removed_ranges``: where they were (start, end)."""
    kept = stored(packed(docs), "documents")
    gone = _repeats(kept.select(ROW_ID, "doc.doc_id", "doc.text"), least_words, whole_lines)
    ranges = gone.groupBy(ROW_ID).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = kept.join(ranges, ROW_ID, "left").withColumn("removed", F.coalesce("removed", none))
    # What lies between the removed ranges, from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform("removed", lambda r: r["end"]))
    ends = F.concat(F.transform("removed", lambda r: r["start"]), F.array(F.length("doc.text")))
    between = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("doc.text"), a + 1, F.greatest(b - a, F.lit(0))))
    text = F.when(F.size("removed") > 0, F.array_join(between, "")).otherwise(F.col("doc.text"))
    new = {"text": text, "n_chars": F.length(text)} if "n_chars" in docs.columns else {"text": text}
    return unpacked(joined, docs, new, {"removed_ranges": F.col("removed")})
