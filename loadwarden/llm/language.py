"""Language identification that labels spans of mixed-language texts.

Every word has a score for each language: the mean log probability of its byte
n-grams, times its length, under counts of all documents that may be learned
from. The word's script narrows the languages to those that use it. A Viterbi
path through the words, with a penalty for each switch, labels them, and words
of one label next to each other are a span; the language with the most letters
is the document's, its share of them the score.

N-grams are counted in a fixed number of hash buckets per language, so tasks
send fixed-size tables, and the model is as large as the languages are many.

Cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text if no document has a language; such texts have no spans. Letters of a script that no language
uses narrow nothing and score alike for all. Null and repeated doc_ids are rows
like others. Columns besides doc_id, text and, for learning, lang play no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map, pieces

UNKNOWN = "und"
BUCKETS = 1 << 16
CHUNK = 1 << 12
SIZES = (3, 4)
SWITCH = 12.0
SMOOTHING = 0.5
#: A language uses a script if at least this share of its words begins with it.
SCRIPT_SHARE = 0.01

#: First code points of script ranges, and the script from there on (0: no script of its own).
_STARTS = [
    0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B80,
    0x0C00, 0x0E00, 0x0E80, 0x10A0, 0x1100, 0x1200, 0x13A0, 0x1E00, 0x1F00, 0x2000, 0x2C60, 0x2C80,
    0x3040, 0x3100, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0x20000,
]
_SCRIPTS = [
    1, 2, 3, 4, 5, 6, 0, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 0, 1, 2, 0, 1, 0, 18, 19, 16, 0, 19, 0, 19,
]
N_SCRIPTS = 20


def _words(texts: pa.Array) -> pa.Array:
    """Lower-cased words of each text, with empty strings where other characters were at its ends."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    return pc.split_pattern(pc.replace_substring_regex(lower, r"[^\pL\pM]+", " "), " ")


def _placed_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``_words`` but the empty ones: each one's text, and where it begins and ends there.

    Lower-casing goes code point by code point and a blank takes the place of each other
    character, so places are those of the text itself: code points, end exclusive.
    """
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    parts = pc.split_pattern(pc.replace_substring_regex(lower, r"[^\pL\pM]", " "), " ")
    words, counts = parts.flatten(), pc.list_value_length(parts).to_numpy()
    lengths = pc.utf8_length(words).to_numpy()
    texts_of = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(lengths + 1)
    begins = np.concatenate(([0], ends))[np.cumsum(counts) - counts]
    real = lengths > 0
    texts_of, lengths = texts_of[real], lengths[real]
    ends = ends[real] - 1 - begins[texts_of]
    return words.filter(pa.array(real)), texts_of, ends - lengths, ends


def _ngrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte n-grams of each word between blanks, and the number of each n-gram's word."""
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    joined = pc.binary_join_element_wise(blank, words, blank, nothing).cast(pa.large_binary())
    ends = np.cumsum(pc.binary_length(joined).to_numpy())
    data = np.frombuffer(b"".join(joined.to_pylist()), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    buckets, owners = [], []
    for size in SIZES:
        if len(data) < size:
            continue
        code = np.zeros(len(data) - size + 1, np.uint64)
        for i in range(size):
            code = (code << np.uint64(8)) | data[i : len(data) - size + 1 + i]
        inside = owner[: len(code)] == owner[size - 1 :]
        code = code[inside] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size)
        buckets.append(((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64))
        owners.append(owner[: len(inside)][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def _scripts(words: list[str]) -> np.ndarray:
    return np.array([_SCRIPTS[bisect_right(_STARTS, ord(w[0])) - 1] if w else 0 for w in words], np.int64)


def _counted(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How often each n-gram bucket and each script occurs in words."""
    coded = words.dictionary_encode()
    n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
    buckets, owners = _ngrams(coded.dictionary)
    grams = np.bincount(buckets, n[owners], BUCKETS).astype(np.int64)
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    scripts = np.bincount(_scripts(coded.dictionary.to_pylist()), np.where(empty, 0, n), N_SCRIPTS)
    return grams, scripts.astype(np.int64)


class LanguageModel:
    """Languages in code point order; scores of n-gram buckets and the scripts that each uses."""

    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = grams.sum(axis=1, keepdims=True)
        self.scores = np.log((grams + SMOOTHING) / (total + SMOOTHING * BUCKETS)).T.astype(np.float32)
        uses = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))
        self.allowed = (uses | ~uses.any(axis=0)).T
        self.known = uses.any(axis=0)
        self.known[0] = True

    def word_scores(self, words: pa.Array) -> np.ndarray:
        buckets, owners = _ngrams(words)
        n = np.maximum(1, np.bincount(owners, minlength=len(words)))
        length = pc.utf8_length(words).to_numpy()
        found = np.empty((len(words), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            found[:, k] = np.bincount(owners, self.scores[buckets, k], len(words)) / n * length
        script = _scripts(words.to_pylist())
        found[~self.known[script]] = 0
        # A language that does not use the script costs more than any switch.
        return np.where(self.allowed[script], found, found.min(axis=1, keepdims=True) - 2 * SWITCH)

    def label(self, texts: pa.Array) -> tuple[list[str], np.ndarray, pa.Array]:
        """The language, its share of the letters and the spans, for each text."""
        # Marks alone are no letters; with letters around they are parts of words.
        # Arrow's lowering is wrong on what if_else and a cast after it make of a slice, so the cast comes first.
        texts = texts.cast(pa.large_string()).fill_null("")
        letters = pc.match_substring_regex(texts, r"\pL")
        words, texts_of, starts, ends = _placed_words(pc.if_else(letters, texts, pa.scalar("", texts.type)))
        coded = words.dictionary_encode()
        places, lengths = coded.indices.to_numpy(), ends - starts
        sizes = np.bincount(texts_of, minlength=len(texts))
        if not self.languages or not len(places):
            nothing = np.zeros(0, np.int64)
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), self._spans(*[nothing] * 4, len(texts))
        path = viterbi(self.word_scores(coded.dictionary), places, sizes)
        n = len(self.languages)
        letters = np.bincount(texts_of * n + path, lengths, len(texts) * n).reshape(-1, n)
        best = letters.argmax(axis=1)
        share = letters.max(axis=1) / np.maximum(1, letters.sum(axis=1))
        names = [self.languages[k] if size else UNKNOWN for k, size in zip(best.tolist(), sizes.tolist())]
        spans = self._spans(path, texts_of, starts, ends, len(texts))
        return names, np.where(sizes > 0, share, 0.0), spans

    def _spans(
        self, path: np.ndarray, texts_of: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_texts: int
    ) -> pa.Array:
        """Runs of words with one label in one text, from the first word's start to the last one's end."""
        changes = (path[1:] != path[:-1]) | (texts_of[1:] != texts_of[:-1])
        first = np.flatnonzero(np.concatenate(([True] * bool(len(path)), changes)))
        last = np.flatnonzero(np.concatenate((changes, [True] * bool(len(path)))))
        names = pa.array(self.languages, pa.string()).take(pa.array(path[first]))
        columns = [pa.array(starts[first], pa.int32()), pa.array(ends[last], pa.int32()), names]
        bounds = np.searchsorted(texts_of[first], np.arange(n_texts + 1))
        structs = pa.StructArray.from_arrays(columns, ["start", "end", "lang"])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs)


def viterbi(scores: np.ndarray, places: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best labels of many sequences at once.

    Sequence i has the next ``sizes[i]`` of ``places``, rows of ``scores``. One step advances
    every sequence that is long enough, the longest ones first in line.
    """
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    long = sizes[order]
    path = np.empty(len(places), np.int64)
    if not len(places):
        return path
    active = np.searchsorted(-long, -np.arange(1, long[0] + 1), "right")
    best = scores[places[begins[: active[0]]]].astype(np.float64)
    stays, tops = [None], [None]
    final = np.empty(active[0], np.int64)
    for t in range(1, long[0]):
        a = active[t]
        if a < len(best):
            final[a : len(best)] = best[a:].argmax(axis=1)
            best = best[:a]
        top = best.argmax(axis=1)
        change = best[np.arange(a), top][:, None] - switch
        stays.append(best >= change)
        tops.append(top)
        best = np.maximum(best, change) + scores[places[begins[:a] + t]]
    final[: len(best)] = best.argmax(axis=1)
    state = final
    for t in reversed(range(long[0])):
        a = active[t]
        path[begins[:a] + t] = state[:a]
        if t:
            rows = np.arange(a)
            state[:a] = np.where(stays[t][rows, state[:a]], state[:a], tops[t])
    return path


def fit_language(docs: DataFrame) -> LanguageModel:
    """Count all words of all documents that have a language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for batch in pieces(batches, 4 << 20):
            for lang in pc.unique(batch.column("lang")).to_pylist():
                part = batch.filter(pc.equal(batch.column("lang"), lang))
                counted = np.concatenate(_counted(_words(part.column("text")).flatten()))
                grams[lang] = grams[lang] + counted if lang in grams else counted
        for lang, table in grams.items():
            starts = [a for a in range(0, len(table), CHUNK) if table[a : a + CHUNK].any()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(starts), pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array([table[a : a + CHUNK].astype("<i8").tobytes() for a in starts], pa.binary()),
                ],
                ["lang", "start", "counts"],
            )

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for part in parts:
            for data in part["counts"]:
                total = total + np.frombuffer(data, "<i8")
        yield pd.DataFrame({"lang": [key[0]], "start": [key[1]], "counts": [total.tobytes()]})

    schema = "lang string, start bigint, counts binary"
    tables = arrow_map(docs.where("lang is not null").select("lang", "text"), count, schema)
    rows = tables.groupBy("lang", "start").applyInPandas(add, schema).collect()
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), BUCKETS + N_SCRIPTS), np.int64)
    for r in rows:
        part = np.frombuffer(r["counts"], "<i8")
        counts[languages.index(r["lang"]), r["start"] : r["start"] + len(part)] = part
    return LanguageModel(languages, counts[:, :BUCKETS], counts[:, BUCKETS:])


def identify_language(docs: DataFrame, model: LanguageModel, batch_bytes: int = 12 << 20) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` (start, end, lang) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = batch_bytes * 8 // max(8, len(shared.value.languages))
        for batch in pieces(batches, most):
            names, score, spans = shared.value.label(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), spans]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
    return arrow_map(docs.select("doc_id", "text"), label, schema)
