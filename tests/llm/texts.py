"""Small corpora with the cases that operators must stand: copies, near copies, shared passages, nulls, long texts."""

from __future__ import annotations

import random

SPACES = " \t\n\r\x0b\x0c"


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"word{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed: int = 5) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    passage, line = words(rng, 60), "Licensed for all, see the terms of use, which hold in every place."
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        own = words(rng, rng.choice([3, 8, 30, 120, 300]))
        if i % 5 == 0:
            own = own + passage + words(rng, 20)
        text = " ".join(own)
        rows.append((i, text + ("\n" + line if i % 7 == 0 else "")))
    base = words(rng, 200)
    for i in range(60, 100):  # near copies, from close to far
        own = list(base)
        for _ in range((i - 60) // 2):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(100 + k, "the same text again and again " * 3) for k in range(12)]
    rows += [(112 + k, " ".join(base)) for k in range(3)]
    rows += [(120, None), (121, ""), (122, " \n\t "), (123, "one"), (124, "one two three"), (125, "ONE two Three"),
             (126, "x" * 49), (127, "x" * 50), (128, "x" * 51), (129, "é" * 40), (130, "ab" * 40),
             (131, " ".join(words(rng, 5000))), (132, " ".join(["again"] * 300)), (None, "a text without an id " * 4),
             (None, None), (133, "漢字" * 60 + "😀"), (5, rows[5][1]), (6, "another text under a known id"),
             (-3, " ".join(base[:150])), (134, "nul\x00 in  it and more\x1c ")]
    return rows
