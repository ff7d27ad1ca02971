"""The rows of the fixtures, for tests that compute what they should give."""

from __future__ import annotations

import random


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(words))


def edited(text: str, share: float, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(f"z{r.randint(0, 10**6)}" if r.random() < share else w for w in text.split(" "))


LONG = prose(1, 30_000)
PASSAGE = prose(2, 60)
ROWS = [
    (1, prose(10, 80)),
    (2, prose(10, 80)),  # copy of 1
    (3, edited(prose(10, 80), 0.01, 3)),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, LONG),
    (8, LONG + " end"),
    (9, prose(11, 40) + " " + PASSAGE + " " + prose(12, 40)),
    (10, prose(13, 40) + " " + PASSAGE + "\n" + prose(14, 40)),
    (11, "two words"),
    (12, "Two  words"),
    (13, "a" * 500),
    (14, "a" * 300),
    (15, "Straße à côté, ÉTÉ 日本語 <|endoftext|> it's 12.5"),
    (15, "Straße à côté, ÉTÉ 日本語 <|endoftext|> it's 12.5"),  # the same row again
    (None, prose(10, 80)),
    (None, "no id here"),
    (16, "write to jo.doe@mail.example.org or call +1 (502) 555-0123 from 10.0.0.1, card 4111 1111 1111 1111"),
    (17, None),
]
