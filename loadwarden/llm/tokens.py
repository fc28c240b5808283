"""Texts to token ids, each distinct piece of text encoded once per worker and remembered.

The public byte-level and word tokenizers encode what lies between certain
places on its own: before a single blank between other characters, between a
letter and a punctuation mark, and around a single line break. Texts are cut
there and their pieces' ids put together again. Pieces recur far more often
than texts, and looking them up is several times faster than encoding them.
Texts with runs of white space or with zero characters are cut more carefully.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
from tokenizers import Tokenizer  # noqa: E402

from loadwarden.llm.rows import kept_in_stage  # noqa: E402

#: Pieces that a worker remembers before it drops the rarer ones; about 200 bytes each.
WORDS_KEPT = 500_000
#: New pieces that are encoded before their encodings are dropped, and words of them that make a line.
AT_ONCE, LINE_WORDS = 1 << 14, 128

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = rf"\x00|^ |{_SPACE} | {_SPACE}| $"
#: Latin and Cyrillic letters that stay one letter when a tokenizer composes or lowers them.
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}\x{400}-\x{45f}]"
_WORD_END = rf"({_LETTER})([!-/:-@\[-`{{-~])"
_LINE_END = r"([\pL\pN!-~])\n([\pL\pN!-~])"
#: In a text without these, no characters combine and each has one lower-case form.
_NOT_SIMPLE = r"[\x{130}\x{300}-\x{10ffff}]"
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")


class WordTokenizer:
    """Ids as the tokenizers library gives them without special tokens."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words_kept = words_kept
        # A tokenizer that lowers its input needs one entry for all ways to write a piece.
        settings = json.loads(self.tokenizer.to_str())
        self.lowers = '"Lowercase"' in json.dumps(settings["normalizer"])
        self.ends = self._word_ends(settings["model"].get("end_of_word_suffix"))
        self._start()

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _start(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.starts, self.sizes = array("I"), array("q"), array("q")
        self.hits = np.zeros(0, np.int64)

    def _word_ends(self, suffix: str | None) -> np.ndarray | None:
        """Which ids end a word, if the vocabulary marks them and a blank before a word makes no difference."""
        words = [self.tokenizer.encode(word, add_special_tokens=False).ids for word in ("a", " a")]
        if not suffix or words[0] != words[1]:
            return None
        ends = np.zeros(self.vocabulary, bool)
        ends[[number for token, number in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        return ends

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not remembered.

        Those of letters alone are words; where an id tells that a word ends, they are encoded in lines of many,
        which takes less than half the time.
        """
        if self.ends is not None and pieces:
            alone = pc.match_substring_regex(pa.array(pieces, pa.large_string()), rf"^ ?{_LETTER}+$").to_pylist()
            words = [piece for piece, letters in zip(pieces, alone) if letters]
            pieces = [piece for piece, letters in zip(pieces, alone) if not letters]
            for i in range(0, len(words), AT_ONCE):
                some = words[i : i + AT_ONCE]
                if not self._add_words(some):
                    pieces += some
        for i in range(0, len(pieces), AT_ONCE):
            some = pieces[i : i + AT_ONCE]
            for piece, encoding in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self._add(piece, encoding.ids)

    def _add_words(self, words: list[str]) -> bool:
        """Encode words line by line and remember them, unless their ids cannot be told apart."""
        spaced = [word if word[0] == " " else f" {word}" for word in words]
        lines = ["".join(spaced[i : i + LINE_WORDS]) for i in range(0, len(spaced), LINE_WORDS)]
        ids = array("I")
        for encoding in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
            ids.extend(encoding.ids)
        ends = np.flatnonzero(self.ends[np.frombuffer(ids, np.uint32)]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return False
        sizes = np.diff(ends, prepend=0)
        self.numbers.update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.starts.frombytes((len(self.ids) + ends - sizes).tobytes())
        self.sizes.frombytes(sizes.tobytes())
        self.ids.extend(ids)
        return True

    def _add(self, piece: str, ids) -> None:
        self.numbers[piece] = len(self.starts)
        self.starts.append(len(self.ids))
        self.ids.extend(ids)
        self.sizes.append(len(ids))

    def _forget_rare(self) -> None:
        """Keep the half that was met most often; what they were met counts half from then on."""
        numbers, hits = self.numbers, self.hits
        ids, starts, sizes = self.ids, self.starts, self.sizes
        bound = max(1, int(np.partition(hits, len(hits) // 2)[len(hits) // 2]))
        self._start()
        kept = [number for number in numbers.values() if hits[number] > bound]
        for piece, number in numbers.items():
            if hits[number] > bound:
                self._add(piece, ids[starts[number] : starts[number] + sizes[number]])
        self.hits = hits[kept] // 2

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start (one more than texts)."""
        if len(self.starts) > self.words_kept:
            self._forget_rare()
        cut = _cut(texts, self.lowers)
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter(map(self.numbers.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(known < 0)
        fresh = [pieces[i] for i in new.tolist()]
        self._learn(fresh)
        known[new] = np.fromiter(map(self.numbers.__getitem__, fresh), np.int64, len(fresh))
        places = coded.indices.to_numpy()
        self.hits = np.pad(self.hits, (0, len(self.starts) - len(self.hits)))
        self.hits[known] += np.bincount(places, minlength=len(pieces))
        flat = known[places]
        sizes = np.frombuffer(self.sizes, np.int64)[flat]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        shift = np.frombuffer(self.starts, np.int64)[flat] - ends[:-1]
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(shift, sizes) + np.arange(ends[-1])]
        offsets = cut.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]


def _cut(texts: pa.Array, lower: bool) -> pa.Array:
    """Each text as a list of pieces that are encoded on their own."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if lower:
        keep = pc.match_substring_regex(texts, _NOT_SIMPLE)
        texts = pc.if_else(keep, texts, pc.utf8_lower(pc.if_else(keep, "", texts)))
    odd = pc.match_substring_regex(texts, _ODD)
    plain = pc.if_else(odd, "", texts)
    plain = pc.replace_substring_regex(plain, _WORD_END, "\\1\x00\\2")
    plain = pc.replace_substring_regex(plain, _LINE_END, "\\1\x00\n\x00\\2")
    cut = pc.split_pattern(pc.replace_substring(plain, " ", "\x00 "), "\x00")
    where = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if not len(where):
        return cut
    careful = pa.array([_BETWEEN.split(texts[i].as_py()) for i in where.tolist()], cut.type)
    place = np.arange(len(texts))
    place[where] = len(texts) + np.arange(len(where))
    return pa.concat_arrays([cut, careful]).take(pa.array(place))


def loaded(path: str, words_kept: int = WORDS_KEPT) -> WordTokenizer:
    """This worker's tokenizer, with what it remembers from earlier tasks of the stage."""
    return kept_in_stage((path, words_kept), lambda: WordTokenizer(path, words_kept))


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
