"""Comparing two extractions of one text: measures by counting, and one ladder of decisions over them.

The measures are linear in the texts. :class:`Known` keeps those of a text that grows, so a fold over many blocks costs what
the blocks hold; :func:`compared` and :func:`coverage` are the same for columns, in Arrow batches.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import text as T

_WORD = re.compile(T.TOKEN)
#: Numbers and codes (a fixed value): the pattern of T.TECHNICAL.
_VALUE = re.compile(r"\b(?:[a-z]*\d[\w./-]*|\d+(?:\.\d+)?)\b", re.I)
DECISIONS = ("empty", "fallback_only", "duplicate", "conflict", "near_duplicate")


def fold(text: str) -> str:
    return text.lower().replace("ß", "ss")


class Sides(NamedTuple):
    """One text's measures."""

    text: str
    words: Counter
    values: frozenset

    @property
    def total(self) -> int:
        return self.words.total()


@lru_cache(maxsize=256)
def measured(text: str) -> Sides:
    plain = fold(" ".join(text.split()))
    return Sides(plain, Counter(_WORD.findall(plain)), frozenset(_VALUE.findall(plain)))


class Known:
    """A primary text that blocks may be added to."""

    def __init__(self, text: str | None):
        self.parts: list[str] = []
        self.words: Counter = Counter()
        self.values: set = set()
        self.add(measured(text or ""))

    def add(self, block: Sides) -> None:
        if block.text:
            self.parts.append(block.text)
            self.words.update(block.words)
            self.values |= block.values

    def shared(self, block: Sides) -> int:
        """Words of ``block``, as a multiset, that are held here."""
        return sum(min(n, self.words[word]) for word, n in block.words.items())

    def holds(self, block: Sides) -> bool:
        """Whether the block stands within the text as it is."""
        return block.text in " ".join(self.parts)

    def decide(self, block: Sides) -> str:
        """The first decision whose condition holds, by counts: shares are compared as whole numbers."""
        if not block.text or not self.parts:
            return "fallback_only" if block.text else "empty"
        if len(self.parts) == 1 and self.parts[0] == block.text:
            return "duplicate"
        shared, total = self.shared(block), block.total
        unlike = bool(self.values - block.values) and bool(block.values - self.values)
        if unlike and total >= 4 and 10 * shared >= 7 * total:
            return "conflict"
        return "near_duplicate" if 10 * shared >= 9 * total or self.holds(block) else "fallback_only"


def decision(primary: str | None, other: str | None) -> str:
    return Known(primary).decide(measured(other or ""))


def compared(primary: Column | str, other: Column | str) -> Column:
    """The decision for ``other`` against ``primary``, one of ``DECISIONS``; nulls count as empty."""

    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([decision(x, y) for x, y in zip(a, b)], dtype=object)

    return run(primary, other)


def coverage(primary: Column, other: Column) -> Column:
    """The share of the tokens of ``other`` (an array), as a multiset, that ``primary`` holds; 1 where ``other`` has none."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        counts = [(Counter(x), Counter(y)) for x, y in zip(a, b)]
        return pd.Series([(x & y).total() / y.total() if y else 1.0 for x, y in counts], dtype=float)

    return run(primary, other)
