"""Texts for the tests and plain words."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "w " * 60_000


def words(text):
    return WORD.findall(text or "")


def sentences(seed, n, vocabulary=200):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def varied(seed, count):
    """Random texts, near copies of some, copies, short ones, empty ones and null."""
    pick = random.Random(seed)
    texts = [sentences(f"{seed}-{i}", pick.randrange(20, 80)) for i in range(count)]
    for text in texts[: count // 2]:
        own = text.split()
        own[pick.randrange(len(own))] = "changed"
        texts += [" ".join(own), text]
    return [*texts, "", None, "one", "One", "two words", "  \t\n ", "naïve café £5 \U0001f600 日本語", LONG]
