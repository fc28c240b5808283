"""A static range asymmetric numeral system over arrays of symbols.

One frequency table is shared by all blocks. A block's symbols are cut into
segments, and a segment's are dealt to lanes; every lane has a state of its
own, and the lanes of a segment share one stream of words. The decoder's first
states and its place in the stream are kept for each segment, so it can start
at any of them. Coding steps run over all lanes of all segments at once.
"""

from __future__ import annotations

import numpy as np

SCALE_BITS = 18
LANES = 32
SEGMENT = 8192
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that add up to a power of two, 1 at least for every symbol that occurs."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint64)
    if np.count_nonzero(counts) > 1 << bits:
        raise ValueError("more symbols than the scale has places")
    # In parts, so that no product leaves 64 bits.
    share = counts // total * (1 << bits) + np.floor(counts % total / total * (1 << bits)).astype(np.int64)
    found = np.where(counts > 0, np.maximum(share, 1), 0)
    over = int(found.sum()) - (1 << bits)
    order = np.argsort(-found, kind="stable")
    if over < 0:
        found[order[0]] -= over
    for i in order:
        if over <= 0:
            break
        cut = min(over, int(found[i]) - 1, max(1, int(found[i]) // 2))
        found[i] -= cut
        over -= cut
    if over > 0:
        spare = np.flatnonzero(found > 1)
        for i in spare[np.argsort(-found[spare], kind="stable")]:
            cut = min(over, int(found[i]) - 1)
            found[i] -= cut
            over -= cut
    return found.astype(np.uint64)


class Coder:
    def __init__(
        self, frequencies: np.ndarray, bits: int = SCALE_BITS, lanes: int = LANES, segment: int = SEGMENT
    ):
        if segment % lanes:
            raise ValueError("a segment has as many symbols in every lane")
        self.frequencies = np.asarray(frequencies, dtype=np.uint64)
        self.firsts = np.cumsum(self.frequencies) - self.frequencies
        self.symbols = np.repeat(
            np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies.astype(np.int64)
        )
        self.bits, self.lanes, self.segment = np.uint64(bits), lanes, segment
        self.filler = int(self.frequencies.argmax()) if len(self.frequencies) else 0

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """The stream, and for each segment its states and how many words of the stream it has."""
        if not len(ids):
            return b"", b"", b""
        if not self.frequencies[ids].all():
            raise ValueError("a symbol is not in the table")
        steps = self.segment // self.lanes
        n = -(-len(ids) // self.segment)
        filled = np.full(n * self.segment, self.filler, np.uint32)
        filled[: len(ids)] = ids
        filled = filled.reshape(n, steps, self.lanes)
        state = np.full((n, self.lanes), _LOW)
        words = np.empty((n, steps, self.lanes), np.uint32)
        written = np.empty((n, steps, self.lanes), bool)
        for t in reversed(range(steps)):
            symbols = filled[:, t]
            frequency = self.frequencies[symbols]
            full = state >= frequency << (np.uint64(63) - self.bits)
            written[:, t] = full
            words[:, t] = state.astype(np.uint32)
            state = np.where(full, state >> _WORD, state)
            quotient = state // frequency
            state = (quotient << self.bits) + (state - quotient * frequency) + self.firsts[symbols]
        counts = written.sum(axis=(1, 2)).astype("<u4")
        return words[written].astype("<u4").tobytes(), state.astype("<u8").tobytes(), counts.tobytes()

    def decode(self, stream: bytes, states: bytes, counts: bytes, n_ids: int) -> np.ndarray:
        if not n_ids:
            return np.zeros(0, np.uint32)
        words = np.append(np.frombuffer(stream, "<u4"), np.uint32(0)).astype(np.uint64)
        sizes = np.frombuffer(counts, "<u4").astype(np.int64)
        state = np.frombuffer(states, "<u8").astype(np.uint64).reshape(len(sizes), self.lanes)
        steps = self.segment // self.lanes
        ids = np.empty((len(sizes), steps, self.lanes), np.uint32)
        place = np.cumsum(sizes) - sizes
        low_bits = (np.uint64(1) << self.bits) - np.uint64(1)
        for t in range(steps):
            slot = state & low_bits
            symbols = self.symbols[slot]
            ids[:, t] = symbols
            state = self.frequencies[symbols] * (state >> self.bits) + slot - self.firsts[symbols]
            short = state < _LOW
            upto = np.cumsum(short, axis=1)
            at = np.minimum(place[:, None] + upto - 1, len(words) - 1)
            state = np.where(short, (state << _WORD) | words[at], state)
            place = place + upto[:, -1]
        if not np.array_equal(place, np.cumsum(sizes)):
            raise ValueError("the stream does not end where it should")
        return ids.reshape(-1)[:n_ids]
