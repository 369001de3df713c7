"""Passages of evaluation items in a corpus, whole or in part, by pigeonhole edit matching.

A passage is a window of ``window`` consecutive units of an item (words, or single letters for scripts without blanks); an
item shorter than that is one passage as a whole. With an error budget of b edits, a passage is split into b + 1 pieces:
at most b of them can be hit by b edits, so a leaked passage contains at least one piece unchanged. A passage may begin at
any unit of its item, so the pieces of window / (b + 1) units are indexed at every offset; exact piece hits come from a
hash table of the items' pieces (the fixed evaluation set, whose size is checked before it is sent to the workers), and each
hit is verified with Myers' bit-parallel distance, run over units instead of characters, between the item around the
piece and the document around the hit. The corpus is read once and never shuffled; only matches are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units that must match in a row, by kind of unit; languages whose unit is the single letter or digit (fixed values).
WORD_WINDOW, LETTER_WINDOW, LETTER_LANGS = 12, 20, ("zh", "ja")
#: Edits that verification forgives; the exact check of p6_found then asks for none.
ERROR_BUDGET = 1
#: Bytes of item text that one pass over the corpus sends to the workers; more items take more passes.
ITEM_BYTES = 4_000_000

#: Dropped before matching: soft hyphen, zero-width characters and joiners, byte order mark (fixed values).
_DROP = dict.fromkeys(map(ord, "\u00ad\u200b\u200c\u200d\u2060\ufeff\u180e"))
_HAS_DROP = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff\u180e]")
_WORD = re.compile(r"[^\W_]+")


def normalise(text: str) -> str:
    """NFKC, without soft hyphens and zero-width characters, in lower case."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        if _HAS_DROP.search(text):
            text = text.translate(_DROP)
            if not unicodedata.is_normalized("NFKC", text):
                text = unicodedata.normalize("NFKC", text)
    return text.lower()


def units(text: str, letters: bool) -> list[str]:
    """The words (maximal runs of letters or digits) of a normalised text, or its single letters and digits."""
    words = _WORD.findall(text)
    return list("".join(words)) if letters else words


def myers(pattern: list, text: list, most: int) -> tuple[int, int]:
    """The least edit distance of the whole ``pattern`` to any stretch of ``text``, and where that stretch ends (exclusive).

    Myers' bit-vector algorithm over units, with one Python integer as a machine word of any width. A distance above
    ``most`` is returned as ``most + 1``.
    """
    m = len(pattern)
    if not m:
        return 0, 0
    where: dict = {}
    for at, unit in enumerate(pattern):
        where[unit] = where.get(unit, 0) | (1 << at)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, unit in enumerate(text):
        eq = where.get(unit, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full  # the top row is 0 everywhere: a match may begin anywhere
        plus = (down | ~(diagonal | up)) & full
        minus = up & diagonal
        if score < best:
            best, end = score, at + 1
    return (best, end) if best <= most else (most + 1, 0)


@dataclass
class Items:
    """The evaluation items of one kind of unit, indexed by the hashes of their pieces."""

    letters: bool
    window: int
    budget: int
    ids: list[int] = field(default_factory=list)
    texts: list[list[str]] = field(default_factory=list)
    by_piece: dict[tuple, list[tuple[int, int]]] = field(default_factory=dict)
    sizes: set[int] = field(default_factory=set)

    def piece_size(self, n: int) -> int:
        """Units of a piece: a window (or the whole short item) holds budget + 1 of them side by side."""
        span = min(n, self.window)
        return max(1, span // (self.budget + 1))

    def add(self, item_id: int, text: list[str]) -> None:
        if not text:
            return
        own, size = len(self.ids), self.piece_size(len(text))
        self.ids.append(item_id)
        self.texts.append(text)
        self.sizes.add(size)
        for at in range(len(text) - size + 1):  # a window may begin anywhere, so pieces stand at every offset
            self.by_piece.setdefault(tuple(text[at : at + size]), []).append((own, at))

    def passages_around(self, own: int, at: int) -> tuple[int, int]:
        """The stretch of the item that all its windows holding the piece at ``at`` lie in."""
        size = self.piece_size(len(self.texts[own]))
        return max(0, at + size - self.window), min(len(self.texts[own]), at + self.window)

    def need(self, own: int) -> int:
        return min(self.window, len(self.texts[own]))


def longest_run(a: list[str], b: list[str], at: int, where: int) -> int:
    """The units in a row that agree on the diagonal through ``a[at]`` and ``b[where]``."""
    low = 0
    while at - low > 0 and where - low > 0 and a[at - low - 1] == b[where - low - 1]:
        low += 1
    high = 0
    while at + high < len(a) and where + high < len(b) and a[at + high] == b[where + high]:
        high += 1
    return low + high


def verify(items: Items, own: int, at: int, doc: list[str], where: int) -> tuple[int, int]:
    """For a piece hit: (errors, run). ``errors`` is the least Myers distance, within the budget, of a passage of the item
    that holds the piece to the document around the hit, budget + 1 if there is none; ``run`` the units in a row that agree."""
    text, need, budget = items.texts[own], items.need(own), items.budget
    low, high = items.passages_around(own, at)
    left = max(0, where - (at - low) - budget)
    around = doc[left : where + (high - at) + budget]
    best = budget + 1
    for start in range(low, high - need + 1):
        distance, _ = myers(text[start : start + need], around, budget)
        best = min(best, distance)
        if not best:
            break
    return best, longest_run(text, doc, at, where)


class Matcher:
    """Finds the items leaked into one document after another; one per task."""

    def __init__(self, groups: list[Items]):
        self.groups = groups
        self.tables = []
        for group in groups:
            if not group.ids:
                continue
            for size in sorted(group.sizes):
                own = {k: v for k, v in group.by_piece.items() if len(k) == size}
                self.tables.append((group, size, own, {k[0] for k in own}))
        #: A document without any of these letters can't hold a piece of the letter groups, unless one is all ASCII.
        self.letter_signs = {c for g in groups if g.letters for k in g.by_piece for c in k if not c.isascii()}
        self.plain_letters = any(all(c.isascii() for c in k) for g in groups if g.letters for k in g.by_piece)
        self.letter_pattern = re.compile("[" + re.escape("".join(sorted(self.letter_signs))) + "]") if self.letter_signs else None

    def hits(self, doc: list[str], group: Items, size: int, own: dict, first: set) -> Iterator[tuple[int, int, int]]:
        """(item, place in the item, place in the document) of every exact piece hit."""
        for where, unit in enumerate(doc):
            if unit in first:
                found = own.get(tuple(doc[where : where + size]))
                if found:
                    for item, at in found:
                        yield item, at, where

    def matches(self, text: str) -> dict[int, tuple[int, int, int]]:
        """{item_id: (errors, longest run, units needed)} for one document, the best of all hits."""
        if not text:
            return {}
        plain = normalise(text)
        words = _WORD.findall(plain)
        joined: list[str] | None = None
        out: dict[int, tuple[int, int, int]] = {}
        for group, size, own, first in self.tables:
            if group.letters:
                if not self.plain_letters and (plain.isascii() or not self.letter_pattern.search(plain)):
                    continue
                if joined is None:
                    joined = list("".join(words))
                doc = joined
            else:
                doc = words
            covered: dict[tuple[int, int], int] = {}
            for item, at, where in self.hits(doc, group, size, own, first):
                diagonal = (item, where - at)
                if covered.get(diagonal, -1) >= where:
                    continue
                errors, run = verify(group, item, at, doc, where)
                if errors > group.budget:
                    continue
                if run >= group.need(item):
                    covered[diagonal] = where + run
                best = out.get(group.ids[item], (group.budget + 1, 0, 0))
                out[group.ids[item]] = (min(errors, best[0]), max(run, best[1]), group.need(item))
        return out


def build_items(rows: Iterable[tuple[int, str | None, str | None]], budget: int = ERROR_BUDGET, word_window: int = WORD_WINDOW, letter_window: int = LETTER_WINDOW) -> list[Items]:
    """Items from (item_id, lang, text); null or blank texts have no units and match nothing."""
    words, letters = Items(False, word_window, budget), Items(True, letter_window, budget)
    for item_id, lang, text in rows:
        group = letters if (lang or "").strip().lower() in LETTER_LANGS else words
        group.add(item_id, units(normalise(text or ""), group.letters))
    return [words, letters]


def find_leaks(documents: DataFrame, items: DataFrame, budget: int = ERROR_BUDGET, word_window: int = WORD_WINDOW, letter_window: int = LETTER_WINDOW) -> DataFrame:
    """(item_id, doc_id, errors, run_units, need_units): every document that holds a passage of an item within ``budget``
    edits. ``errors`` are those of its best passage, ``run_units`` the most units in a row that agree exactly.

    An item of no more units than the budget matches only where it stands whole: the edits would leave nothing of it.
    Null texts and ids match nothing; a repeated item or document counts once. The items are sent to the workers in parts of
    about ``ITEM_BYTES``, by the hash of their ids, one pass over the corpus for each part; a usual evaluation set is one.
    """
    own = items.select("item_id", "lang", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / ITEM_BYTES))
    source = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    found = [_one_pass(source, own if parts == 1 else own.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == no), budget, word_window, letter_window) for no in range(parts)]
    whole = reduce(DataFrame.unionByName, found)
    return whole.groupBy("item_id", "doc_id").agg(F.min("errors").alias("errors"), F.max("run_units").alias("run_units"), F.max("need_units").alias("need_units"))


def _one_pass(source: DataFrame, items: DataFrame, budget: int, word_window: int, letter_window: int) -> DataFrame:
    """The matches of one part of the items, whose size the caller bounds, with every document."""
    sent = source.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(build_items(sent.value, budget, word_window, letter_window))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(item, doc_id, *m) for item, m in matcher.matches(text.as_py()).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["item_id", "doc_id", "errors", "run_units", "need_units"])

    return source.mapInArrow(run, "item_id bigint, doc_id bigint, errors int, run_units int, need_units int")


def exact_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id) where a passage stands in the document without an edit: Myers' distance of its best passage is 0."""
    return find_leaks(documents, items).where(F.col("errors") == 0).select("item_id", "doc_id")


def leaked_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document concerned: (doc_id, n_items, n_exact, least_errors); the items leaked into it are counted."""
    found = find_leaks(documents, items)
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.count_if(F.col("errors") == 0).alias("n_exact"), F.min("errors").alias("least_errors"))
