"""Secrets in texts, found by regular expressions behind a trigram index.

Every rule's expression gives a Boolean query over trigrams. Each task indexes
a few megabytes of texts at a time: postings of the trigrams that any rule
needs, intersected per rule. Only the texts that remain are searched by the
expression, in full; a rule without mandatory trigrams searches every text.
Documents are never moved, so no group of them can grow.

Cases: a null or empty text has no spans; null and repeated doc_ids are rows
like any other; columns besides the text are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map, pieces
from loadwarden.llm.trigrams import TrigramIndex, trigram_query

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters.

    ``head`` is what every match begins with, ``run`` the characters of which its first part, up to
    another one, consists: where that part is followed by what cannot match, no later head in
    the same run of characters can match either, and none is tried.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    head: str = ""
    run: str = ""

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


#: The rules that every scan has.
BASE_RULES = (
    Rule(
        "assign",
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, head="eyJ", run="[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE_RULES + MORE_RULES


def matches(rule: Rule, pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """The matches of the rule's pattern, as ``finditer`` has them."""
    if not rule.head:
        yield from pattern.finditer(text)
        return
    run = re.compile(rule.run, rule.flags)
    at = text.find(rule.head)
    while at >= 0:
        match = pattern.match(text, at)
        if match is not None:
            yield match
        at = text.find(rule.head, (match or run.match(text, at)).end())


class Scanner:
    """The rules ready to search batches of texts."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(rule, re.compile(rule.pattern, rule.flags)) for rule in rules]
        self.queries = [trigram_query(rule.pattern, rule.flags) for rule in rules]
        self.index = TrigramIndex(self.queries)

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its spans as (start, number of the rule, end), in this order."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.index.build(data, offsets - offsets[0])
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        decoded: dict[int, str] = {}
        for k, (rule, pattern) in enumerate(self.rules):
            for i in self.index.candidates(self.queries[k]).tolist():
                if i not in decoded:
                    decoded[i] = texts[i].as_py().decode()
                for match in matches(rule, pattern, decoded[i]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[i].append((match.start(), k, match.end()))
        return [sorted(spans) for spans in found]


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id`` and the spans of each text by start, then rule; code points, end exclusive."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, kinds = Scanner(rules), [rule.kind for rule in rules]
        for batch in pieces(batches):
            spans = [
                [{"kind": kinds[k], "start": start, "end": end} for start, k, end in found]
                for found in scanner.spans(batch.column("text"))
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), scan, f"doc_id {kind}, spans {SPANS}")


def redact_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """The documents with ``mask`` in place of every span, or of spans that touch or overlap."""
    names = docs.columns

    def redact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in pieces(batches):
            columns = list(batch.columns)
            texts = columns[names.index("text")]
            found = scanner.spans(texts)
            if any(found):
                new = [_masked(t, spans, mask) for t, spans in zip(texts.to_pylist(), found)]
                columns[names.index("text")] = pa.array(new, texts.type)
                if "n_chars" in names:
                    old = columns[names.index("n_chars")]
                    sizes = [
                        len(t) if spans else n
                        for t, spans, n in zip(new, found, old.to_pylist())
                    ]
                    columns[names.index("n_chars")] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return arrow_map(docs, redact, docs.schema)


def _masked(text: str | None, spans: list[tuple[int, int, int]], mask: str) -> str | None:
    if not spans:
        return text
    parts, at = [], -1
    for start, _, end in spans:
        if start > at:
            parts += [text[max(at, 0) : start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
