"""Counts the tables of ordinary strings in ``secret_scan``: python -m fixedrecon.llm.letter_model

They come from the source files of the Python interpreter's own standard library (3.13, without its tests, whose
data hold encoded strings): English prose, identifiers and paths. Each distinct word counts once, and a share of
uniform choices stands for other languages and names. Quarter bits in base 36, a row for each letter."""

from __future__ import annotations

import math
import re
import sysconfig
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

LETTERS = "abcdefghijklmnopqrstuvwxyz"
UNIFORM_LETTERS, UNIFORM_CLASSES = 0.1, 0.05


def kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _code(share: float) -> str:
    quarters = min(35, round(-4 * math.log2(share)))
    return "0123456789abcdefghijklmnopqrstuvwxyz"[quarters]


def _mixed(counts: Counter, row: object, choices: Iterable, uniform: float) -> list[float]:
    choices = list(choices)
    total = sum(counts[row, c] for c in choices)
    if not total:
        return [1 / len(choices)] * len(choices)
    return [(1 - uniform) * counts[row, c] / total + uniform / len(choices) for c in choices]


def tables(words: Iterable[str]) -> tuple[list[list[float]], list[str], str]:
    """(shares of classes after each class and at the start, letter pairs, first letters) of distinct words."""
    classes, pairs = Counter(), Counter()
    for word in set(words):
        before, letter = 4, None
        for c in word:
            now = kind(c)
            classes[before, now] += 1
            low = c.lower() if now < 2 else None
            if low is not None:
                pairs[letter, low] += 1
            before, letter = now, low
    follows = [[round(x, 3) for x in _mixed(classes, i, range(4), UNIFORM_CLASSES)] for i in range(5)]
    rows = ["".join(map(_code, _mixed(pairs, a, LETTERS, UNIFORM_LETTERS))) for a in [*LETTERS, None]]
    return follows, rows[:-1], rows[-1]


def library_words() -> Iterator[str]:
    root = Path(sysconfig.get_path("stdlib"))
    tabular = {"encodings", "stringprep.py", "entities.py"}  # code points, no words
    for path in sorted(root.rglob("*.py")):
        if not {"test", "tests", "site-packages", "idlelib", *tabular} & set(path.relative_to(root).parts):
            yield from re.findall(r"[A-Za-z0-9+/_-]{4,40}", path.read_text("utf-8", "ignore"))


if __name__ == "__main__":
    follows, pairs, first = tables(library_words())
    print("FOLLOWS =", follows)
    for i in range(0, 26, 4):
        print(" ".join(pairs[i : i + 4]))
    print("FIRST_LETTERS =", first)
