"""Texts for the tests of this folder."""

from __future__ import annotations

import random

#: Texts that every operator must survive.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "same words here for all of you"),
    (6, "same words here for all of you"),
    (6, "same words here for all of you"),
    (None, "no number but some words of its own"),
    (7, "日本語 😀 ñandú x y \x00 z"),
    (8, "long " * 30_000 + "end"),
]


def words(rng: random.Random, n: int, kind: str = "aeiou") -> list[str]:
    return ["".join(rng.choice("bcdfglmnprst") + rng.choice(kind) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def sentence(rng: random.Random, n: int = 12, kind: str = "aeiou") -> str:
    return " ".join(words(rng, n, kind)).capitalize() + "."


def texts_like_prose(n: int, first: int = 1, seed: int = 3) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    return [(first + i, "\n".join(sentence(rng) for _ in range(rng.randint(1, 30)))) for i in range(n)]
