"""Boolean trigram queries of regular expressions, and an inverted index to answer them.

The index folds A-Z to lower case, so a query finds a superset of the texts in
which its expression matches, whatever the expression's own case.
"""

from __future__ import annotations


from re import _constants as op
from re import _parser as parser

import numpy as np

#: The most strings that an expression's fixed part is spelled out to.
MOST_STRINGS = 64

#: Alternatives, of which one must hold: sets of trigrams that must all be there. None: no condition.
Query = frozenset[frozenset[bytes]] | None


def trigram_query(pattern: str, flags: int = 0) -> Query:
    return _all(_walk(parser.parse(pattern, flags)))


def _all(parts: list[Query]) -> Query:
    """The query that all of ``parts`` hold; only the most selective few are multiplied out."""
    parts = sorted((p for p in parts if p is not None), key=len)
    if not parts:
        return None
    found = parts[0]
    for part in parts[1:]:
        if len(found) * len(part) > MOST_STRINGS:
            continue
        found = frozenset(a | b for a in found for b in part)
    return _least(found)


def _least(clauses: frozenset) -> frozenset:
    return frozenset(a for a in clauses if not any(b < a for b in clauses))


def _strings(strings: set[bytes]) -> Query:
    if any(len(s) < 3 for s in strings):
        return None
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _walk(items) -> list[Query]:
    """What a sequence demands: runs of parts with few spellings give their strings' trigrams."""
    demands: list[Query] = []
    run: set[bytes] = {b""}

    def ended() -> None:
        nonlocal run
        demands.append(_strings(run))
        run = {b""}

    for item in items:
        spelled, closed = _spellings(item)
        if spelled is not None and len(run) * len(spelled) <= MOST_STRINGS:
            run = {a + b for a in run for b in spelled}
            if not closed:
                ended()
            continue
        ended()
        demands.extend(_inner(item))
    ended()
    return demands


def _spellings(item) -> tuple[set[bytes] | None, bool]:
    """All strings that the item stands for, if few; False where more of them may follow."""
    kind, value = item
    if kind is op.LITERAL:
        return {chr(value).encode().lower()}, True
    if kind is op.IN:
        found = set()
        for what, x in value:
            if what is op.LITERAL:
                found.add(chr(x).encode().lower())
            elif what is op.RANGE and x[1] - x[0] < MOST_STRINGS:
                found |= {chr(c).encode().lower() for c in range(x[0], x[1] + 1)}
            else:
                return None, True
        return (found, True) if len(found) <= 8 else (None, True)
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        found = set()
        for branch in value[1]:
            strings, closed = _sequence(branch)
            if strings is None or not closed:
                return None, True
            found |= strings
        return found, True
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        strings, closed = _sequence(inner)
        if strings is None or not closed:
            return None, True
        if most == 1:
            return (strings | {b""} if least == 0 else strings), True
        if least >= 1:
            return strings, False
    return None, True


def _sequence(items) -> tuple[set[bytes] | None, bool]:
    found = {b""}
    for i, item in enumerate(items):
        strings, closed = _spellings(item)
        if strings is None or len(found) * len(strings) > MOST_STRINGS:
            return None, True
        found = {a + b for a in found for b in strings}
        if not closed:
            return (found, False) if i == len(items) - 1 else (None, True)
    return found, True


def _inner(item) -> list[Query]:
    """The demands of a part that has too many spellings."""
    kind, value = item
    if kind is op.SUBPATTERN:
        return _walk(value[3])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _walk(value[2])
    if kind is op.BRANCH:
        branches = [_all(_walk(branch)) for branch in value[1]]
        if all(b is not None for b in branches):
            return [_least(frozenset().union(*branches))]
    return []


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


class TrigramIndex:
    """Which texts have which of the trigrams that some queries need."""

    def __init__(self, queries: list[Query]):
        needed = sorted({t for query in queries for clause in query or () for t in clause})
        self.number = {t: i + 1 for i, t in enumerate(needed)}
        self.at = np.zeros(1 << 24, dtype=np.uint16)
        for trigram, i in self.number.items():
            self.at[int.from_bytes(trigram, "big")] = i
        self.postings: list[np.ndarray] = []
        self.size = 0

    def build(self, data: np.ndarray, offsets: np.ndarray) -> None:
        """Post the texts that lie in ``data`` one after the other, text i from offsets[i] on."""
        self.size = len(offsets) - 1
        folded = _FOLD[data].astype(np.uint32)
        codes = folded[:-2] << 16 if len(data) > 2 else folded[:0]
        if len(codes):
            codes |= folded[1:-1] << 8
            codes |= folded[2:]
        numbers = self.at[codes]
        places = np.flatnonzero(numbers)
        first = np.searchsorted(offsets, places, "right") - 1
        inside = places + 3 <= offsets[first + 1]  # not across two texts
        pairs = np.unique(numbers[places[inside]].astype(np.int64) * self.size + first[inside])
        cuts = np.searchsorted(pairs, np.arange(len(self.number) + 2) * self.size)
        self.postings = [pairs[a:b] % self.size for a, b in zip(cuts[:-1], cuts[1:])]

    def candidates(self, query: Query) -> np.ndarray:
        """The texts, ascending, in which the query holds; all of them without a condition."""
        if query is None:
            return np.arange(self.size)
        found = [self._intersect(clause) for clause in query]
        return np.unique(np.concatenate(found)) if found else np.arange(0)

    def _intersect(self, clause: frozenset[bytes]) -> np.ndarray:
        lists = sorted((self.postings[self.number[t]] for t in clause), key=len)
        found = lists[0]
        for other in lists[1:]:
            found = np.intersect1d(found, other, assume_unique=True)
        return found


