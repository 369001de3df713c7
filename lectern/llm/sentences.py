"""Sentence units of documents in any language, script and layout.

The boundary rules are compiled into a finite transducer. Its input symbols are the few places of a text that can matter
(marks, quotation marks, brackets, blank lines, list lines, spaces between Thai letters), each classified by a look around
it; its states say whether the text stands outside any quotation or bracket, and if not, inside which kind, how deep, and
whether that was opened at a sentence's start. A short document is run through it in one go. A document longer than
``CHUNK_CHARS`` is cut into chunks, with the same result: a scan from the end tells each chunk which closing marks still
follow in its last block; each chunk then yields its state-transition function (the end state for every start state), the
functions are composed by a parallel prefix scan (groups of chunks, then the groups of a document), and each chunk emits its
units from the state it is entered with.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.plans.lineage import cut as cut_lineage

#: Characters of a chunk, and what of the text around it is read along, more than any look around an event needs.
CHUNK_CHARS, HALO_BEFORE, HALO_AFTER = 262_144, 256, 64
#: Chunks whose functions one task composes in the first step of the scan.
SCAN_GROUP = 64

# Marks, pairs, abbreviations.
MARKS = ".!?…。！？｡।॥؟۔‼⁇⁈⁉"
_ELLIPSIS = re.compile(r"\.{2,}|…")
#: (opening, closing, is a bracket). A straight quotation mark both opens and closes.
PAIRS = (('"', '"', False), ("“", "”", False), ("„", "“", False), ("«", "»", False), ("»", "«", False), ("‘", "’", False), ("「", "」", False), ("『", "』", False), ("(", ")", True), ("（", "）", True), ("[", "]", True), ("【", "】", True), ("《", "》", True))
_CLOSERS = "\"”“’»«」』)）]】》*_"
#: Closing signs taken along after a mark without asking which pair they belong to.
_RUN = "”’」』)）]】》*_"
_LEAD = "\"“„«»‘'「『(（[【《*_—–-"
#: Abbreviations after whose point a sentence never ends, and those after which it may.
NEVER = frozenset("approx fig figs tab sect sec dept rev max min vs esp abb kap vgl ca bzw ggf evtl inkl exkl sog cf réf env aprox núm pág pag ej dr mr mrs ms prof abs bsp bspw dgl zzt chap resp incl ص डॉ".split())
#: Abbreviations only where a number follows; else words like others.
NUMBERED = frozenset("no nos nr num art vol st ch ed éd ref eq ver pos fr bd".split())
MAY = frozenset("etc usw a.m p.m u.a u.ä inc ltd co jr sr corp al".split())
#: Words before a German ordinal number.
_ORDINAL = frozenset("am im vom zum zur beim den der dem des die das ein einem einen ab bis seit nach".split())
_PARTICLES = "とがはをのにでもやへってかな的"

_THAI = "฀-๏๚-๿"
_BLANK = r"[^\S\r\n]"
_NL = r"(?:\r\n|\n|\r|\u2028|\u2029)"
_LIST = r"(?:[-*•+–‣◦▪●·○■]|\d{1,4}[.)．）])"
_EVENT = re.compile(
    rf"(?P<brk>{_NL}(?:{_BLANK}*{_NL})+{_BLANK}*|{_NL}(?={_BLANK}*{_LIST}{_BLANK}))"
    r"|(?P<mark>(?:[!?…。！？｡।॥؟۔‼⁇⁈⁉]|\.(?![a-z0-9_/]))[.!?…。！？｡।॥؟۔‼⁇⁈⁉]*)"
    r"|(?P<pair>[\"“”„«»‘’「」『』()（）\[\]【】《》])"
    rf"|(?P<thai>(?<=[{_THAI}]){_BLANK}+(?=[{_THAI}]))"
)
_AFTER = re.compile(r"\s*")
_HARD = re.compile(rf"{_BLANK}*(?:{_NL}{_BLANK}*(?:{_NL}|{_LIST}{_BLANK})|\Z)")
_HARD_AHEAD = re.compile(rf"{_NL}{_BLANK}*(?:{_NL}|{_LIST}{_BLANK})")
_TOKEN = re.compile(r"[^\s\"“”„«»‘’「」『』()（）\[\]【】《》]*\Z")
_LAST_WORD = re.compile(r"(\w+)\s+\Z")

# ---- the transducer ----

_FRESH, _WITHIN = 0, 1
#: A transducer is finite: of one kind, so many levels within each other are told apart, more than any text was seen to hold.
_DEPTHS = 64
STATES = 2 + len(PAIRS) * 2 * _DEPTHS


def _inside(pair: int, fresh: int, depth: int) -> int:
    return 2 + (pair * 2 + fresh) * _DEPTHS + depth - 1


#: Symbols: an end, a break, and for each sign of a pair whether it can open one and whether a sentence may end with it.
_END, _BREAK = 0, 1
SIGNS = sorted({sign for pair in PAIRS for sign in pair[:2]})
SYMBOLS = 2 + len(SIGNS) * 4
_SIGN = {sign: 2 + 4 * no for no, sign in enumerate(SIGNS)}
_CLOSING_OF = {opening: closing for opening, closing, _ in PAIRS}


def _compile() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emits a boundary) by state and 2 * symbol + (text stands before the symbol)."""
    goes = np.repeat(np.arange(STATES)[:, None], 2 * SYMBOLS, axis=1)
    emits = np.zeros((STATES, 2 * SYMBOLS), bool)
    columns = {sign: np.arange(2 * first, 2 * first + 8).reshape(2, 2, 2) for sign, first in _SIGN.items()}  # opens, ends, text
    goes[_FRESH, 1::2] = _WITHIN
    for state, text in ((_FRESH, 0), (_FRESH, 1), (_WITHIN, 0), (_WITHIN, 1)):
        goes[state, 2 * _END + text], emits[state, 2 * _END + text] = _FRESH, True
        for no, (opening, _, _) in enumerate(PAIRS):
            goes[state, columns[opening][1, :, text]] = _inside(no, int(state == _FRESH and not text), 1)
    for no, (opening, closing, bracket) in enumerate(PAIRS):
        for fresh in (0, 1):
            first, last = _inside(no, fresh, 1), _inside(no, fresh, _DEPTHS)
            deeper = np.arange(first, last)[:, None]
            if opening != closing:
                goes[first:last, columns[opening].ravel()] = deeper + 1
            goes[first + 1 : last + 1, columns[closing].ravel()] = deeper
            goes[first, columns[closing].ravel()] = _WITHIN
            if fresh or not bracket:
                ending = columns[closing][:, 1].ravel()
                goes[first, ending], emits[first, ending] = _FRESH, True
    goes[:, 2 * _BREAK : 2 * _BREAK + 2], emits[:, 2 * _BREAK : 2 * _BREAK + 2] = _FRESH, True
    return goes, emits


_GOES, _EMITS = _compile()
GOES, EMITS = _GOES.tolist(), _EMITS.tolist()


# ---- classification of events, by a bounded look around ----


def _starts(text: str, at: int, size: int, after: str) -> bool:
    """Whether what follows ``at`` can begin a sentence. after: 'mark', 'ellipsis' or 'closer', what stands before it."""
    if _HARD.match(text, at):
        return True
    at = _AFTER.match(text, at).end()
    while at < size:
        c = text[at]
        if c in "¿¡":
            return True
        if c not in _LEAD:
            break
        at += 1
        while at < size and text[at] in " \u00a0\u2009\u202f":
            at += 1
    if at >= size:
        return True
    c = text[at]
    if c.islower():
        return at + 1 < size and text[at + 1].isupper()
    if c.isupper() or c.isdigit():
        return True
    if c.isalpha():
        if after == "ellipsis":
            return False
        if c in _PARTICLES:
            if after == "closer":
                return False
            return not (c == "と" and at + 1 < size and not "぀" <= text[at + 1] <= "ゟ")
        return True
    return c not in ",;:，；：、،؛)）]】》」』”’%&/=<>" and c not in MARKS


def _point_ends(text: str, at: int, end: int, size: int) -> bool:
    """Whether a single point ends a sentence where no quotation is open."""
    token = _TOKEN.search(text, max(0, at - 64), at)[0]
    following = text[end] if end < size else ""
    low = token.lower()
    if token:
        last = token[-1]
        if "฀" <= last <= "๿" or "ऀ" <= last <= "ॿ":
            return False
        if following.isalpha():  # the blank after the mark may be missing
            if not following.isupper() or "/" in token or "_" in token or "@" in token:
                return False
            after = text[end + 1] if end + 1 < size else " "
            if not (after.islower() or after in " \u00a0\u2009\u202f" or after in "'’") or low in NEVER or len(token) == 1 or not (last.islower() or last.isdigit()):
                return False
            return True
        if low in MAY:
            return _starts(text, end, size, "mark")
        if low in NEVER or (len(token) == 1 and last.isalpha()) or (low in NUMBERED and text[end : end + 8].lstrip()[:1].isdigit()):
            return False
        if "." in token and "/" not in token and all(len(x.strip("-‑")) <= 2 and not any(map(str.isdigit, x)) for x in token.split(".")):
            return False
        if token.isdigit():
            first = at - len(token)
            before = text[max(0, first - 40) : first].rstrip(" \u00a0\u2009\u202f\t")
            if not before or before[-1] in "\r\n":
                return False
            word = _LAST_WORD.search(text, max(0, first - 24), first)
            if word and word[1].lower() in _ORDINAL:
                return False
    elif at and text[at - 1].isspace() and following and not following.isspace():
        return False
    return _starts(text, end, size, "mark")


_CLOSING = sorted(set(_CLOSING_OF.values()))
_CLOSING_BIT = {sign: 1 << no for no, sign in enumerate(_CLOSING)}
_CLOSING_SIGN = re.compile("[" + re.escape("".join(_CLOSING)) + "]")


class _Ahead:
    """Whether an opening mark counts: its closing mark follows in the same block, however far. What was found stays known
    until the text has passed it, so that asking for all opening marks goes through the text once."""

    def __init__(self, text: str, high: int, beyond: int):
        self.text, self.high, self.beyond = text, high, beyond
        self.hard = -1
        self.next: dict[str, int] = {}

    def closes(self, at: int, closing: str) -> bool:
        if self.hard <= at:
            met = _HARD_AHEAD.search(self.text, at + 1)
            self.hard = met.start() if met and met.start() < self.high else len(self.text) + 1
        found = self.next.get(closing, -1)
        if found <= at:
            found = self.text.find(closing, at + 1, self.high)
            found = self.next[closing] = found if found >= 0 else len(self.text) + 1
        return found < min(self.hard, self.high) or (self.hard > self.high and bool(self.beyond & _CLOSING_BIT[closing]))


def closing_marks(text: str, low: int, high: int) -> tuple[int, bool]:
    """(the closing marks of [low, high) before its first hard break, whether there is one)."""
    met = _HARD_AHEAD.search(text, low)
    hard = met is not None and met.start() < high
    signs = set(_CLOSING_SIGN.findall(text, low, met.start() if hard else high))
    return sum(_CLOSING_BIT[sign] for sign in signs), hard


def events(text: str, low: int, high: int, beyond: int = 0) -> tuple[list[int], list[int]]:
    """(symbols with the text flag, cut positions) of the events that begin in [low, high) of ``text``; ``beyond``: the closing
    marks that follow after ``high`` in the block that goes on there."""
    size = len(text)
    symbols, cuts, ahead = [], [], _Ahead(text, high, beyond)
    done = first = low
    while first > 0 and (text[first - 1] in MARKS or text[first - 1].isspace()):
        first -= 1  # a group of marks or blanks that a chunk's edge parts belongs to the chunk it begins in
    for met in _EVENT.finditer(text, first):
        at = met.start()
        if at >= high:
            break
        end, kind = met.end(), met.lastgroup
        if at < low:
            done = max(done, end)
            continue
        if kind == "mark":
            group = met[0]
            cut = end
            while cut < size and text[cut] in _RUN:
                cut += 1
            if group == ".":
                ends = _point_ends(text, at, cut, size)
            elif not group.strip(".") or not group.strip("…"):
                ends = _starts(text, cut, size, "ellipsis")
            else:
                ends = not (end < size and text[end].isalnum() and "/" in _TOKEN.search(text, max(0, at - 64), at)[0]) and _starts(text, cut, size, "mark")
            if ends:
                symbols.append(2 * _END + 1)
                cuts.append(cut)
                done = end
        elif kind == "thai":
            symbols.append(2 * _END + 1)
            cuts.append(at)
            done = end
        elif kind == "brk":
            symbols.append(2 * _BREAK + (at > done and not text[done:at].isspace()))
            cuts.append(at)
            done = end
        else:
            sign, cut, ends = met[0], end, False
            before = text[max(0, at - 8) : at].rstrip()
            while before and before[-1] in _CLOSERS:
                before = before[:-1].rstrip()
            if before and before[-1] in MARKS:
                while cut < size and text[cut] in _RUN:
                    cut += 1
                ends = _starts(text, cut, size, "closer")
            closing = _CLOSING_OF.get(sign)
            opens = closing is not None and ahead.closes(at, closing)
            symbols.append(2 * (_SIGN[sign] + 2 * opens + ends) + (at > done and not text[done:at].isspace()))
            cuts.append(cut)
            done = cut if ends else at
    return symbols, cuts


def boundaries(text: str) -> list[int]:
    """The cut positions of a whole text, from the transducer's start state."""
    state, out = _FRESH, []
    for symbol, cut in zip(*events(text, 0, len(text))):
        if EMITS[state][symbol]:
            out.append(cut)
        state = GOES[state][symbol]
    return out


def _blank_ends(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    return start, end


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of every sentence unit, in order; blank text has none."""
    out, start = [], 0
    for cut in boundaries(text):
        if cut > start:
            a, b = _blank_ends(text, start, cut)
            if a < b:
                out.append((a, b))
            start = cut
    a, b = _blank_ends(text, start, len(text))
    if a < b:
        out.append((a, b))
    return out


# ---- long documents: chunks as functions, composed by a prefix scan ----


_RUN_ON = re.compile("[" + re.escape(MARKS + _RUN + _LEAD + "¿¡") + r"\s]*")


def chunk_edges(text: str, size: int) -> list[int]:
    """Edges of chunks of at least ``size`` characters. None falls into a run of marks, quotes, brackets and blanks, which is
    what a look around an event goes along, however long it is."""
    out = [0]
    while out[-1] + size < len(text):
        at = _RUN_ON.match(text, out[-1] + size).end()
        if at >= len(text):
            break
        out.append(at)
    return [*out, len(text)]


def chunk_function(text: str, low: int, high: int, beyond: int = 0) -> np.ndarray:
    """The state-transition function of the chunk [low, high) of ``text``: its end state for every start state.

    Text after the last event moves a fresh state on, so that composing functions equals running through.
    """
    symbols, cuts = events(text, low, high, beyond)
    ends = np.arange(STATES)
    for symbol in symbols:
        ends = _GOES[ends, symbol]
    if text[max(low, cuts[-1] if cuts else low) : high].strip():
        ends = np.where(ends == _FRESH, _WITHIN, ends)
    return ends.astype(np.int16)


def compose_prefix(functions: np.ndarray) -> np.ndarray:
    """All prefix compositions of ``functions`` (n, states) by a parallel scan of log2(n) steps: row i is f_i after ... after f_0."""
    out = np.array(functions, copy=True)
    step = 1
    while step < len(out):
        later = out[step:].copy()
        out[step:] = np.take_along_axis(later, out[:-step], axis=1)
        step *= 2
    return out


def chunk_boundaries(text: str, low: int, high: int, state: int, beyond: int = 0) -> list[int]:
    """The cuts that the chunk [low, high) emits when entered with ``state``."""
    out = []
    for symbol, cut in zip(*events(text, low, high, beyond)):
        if EMITS[state][symbol]:
            out.append(cut)
        state = GOES[state][symbol]
    return out


_CHUNK = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("no", pa.int32()), ("start", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("last", pa.bool_()), ("closers", pa.int32()), ("hard", pa.bool_()), ("body", pa.string())])


def _chunks(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The chunks of the texts longer than ``size``, each with its halos: ``low`` and ``high`` are its ends within ``body``,
    ``start`` the body's offset; ``closers`` and ``hard`` as :func:`closing_marks` gives them. ``row`` tells texts of one key
    apart. Goes through each text once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                whole = body.as_py()
                edges = chunk_edges(whole, size)
                for no, (low, high) in enumerate(zip(edges, edges[1:])):
                    start, end = max(0, low - HALO_BEFORE), min(len(whole), high + HALO_AFTER)
                    part = whole[start:end]
                    values = (row, own, no, start, low - start, high - start, high == len(whole), *closing_marks(part, low - start, high - start), part)
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CHUNK)], schema=_CHUNK)

    long = documents.where(F.char_length(text) > size).select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("_t"))
    return long.mapInArrow(run, "row bigint, key bigint, no int, start bigint, low int, high int, last boolean, closers int, hard boolean, body string")


def _ahead_of(chunks: DataFrame) -> DataFrame:
    """Chunks with ``beyond``, the closing marks that follow in the block that goes on behind each: a scan from the end over
    one small row per chunk (a value has at most 2^31 bytes, so a text has a few thousand chunks at most)."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no", ascending=False)
        out, held = [], 0
        for closers, hard in zip(rows["closers"], rows["hard"]):
            out.append(held)
            held = closers if hard else closers | held
        return rows[["row", "no"]].assign(beyond=np.array(out, np.int32))

    found = chunks.select("row", "no", "closers", "hard").groupBy("row").applyInPandas(scan, "row bigint, no int, beyond int")
    return chunks.join(found, ["row", "no"])


def _entered(ahead: DataFrame) -> DataFrame:
    """(row, no, before, entry): each chunk's state on entry is before[entry], by a prefix scan in two steps. ``before``
    composes the functions of the chunks before it in its group, ``entry`` is the state in which its group is entered."""

    def functions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            made = [chunk_function(body, low, high, beyond).tobytes() for body, low, high, beyond in zip(d["body"], d["low"], d["high"], d["beyond"])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("no"), pa.array(made, pa.binary())], names=["row", "no", "f"])

    def within_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no")
        through = compose_prefix(np.stack([np.frombuffer(f, np.int16) for f in rows["f"]]))
        before = [np.arange(STATES, dtype=np.int16), *through[:-1]]
        return pd.DataFrame({"row": rows["row"], "part": rows["part"], "no": rows["no"], "before": [f.tobytes() for f in before], "whole": [None] * (len(rows) - 1) + [through[-1].tobytes()]})

    def across_groups(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        through = compose_prefix(np.stack([np.frombuffer(f, np.int16) for f in rows["whole"]]))
        return pd.DataFrame({"row": rows["row"], "part": rows["part"], "entry": np.concatenate([[_FRESH], through[:-1, _FRESH]]).astype(np.int32)})

    made = ahead.select("row", "no", "low", "high", "beyond", "body").mapInArrow(functions, "row bigint, no int, f binary")
    grouped = made.withColumn("part", F.floor(F.col("no") / SCAN_GROUP).cast("int")).groupBy("row", "part").applyInPandas(within_group, "row bigint, part int, no int, before binary, whole binary")
    grouped = cut_lineage(grouped)
    entries = grouped.where(F.col("whole").isNotNull()).select("row", "part", "whole").groupBy("row").applyInPandas(across_groups, "row bigint, part int, entry int")
    return grouped.select("row", "part", "no", "before").join(entries, ["row", "part"]).select("row", "no", "before", "entry")


def long_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK_CHARS) -> DataFrame | None:
    """(doc_id, start_char, end_char) of the texts longer than ``size``, chunk by chunk, equal to :func:`sentence_spans`; None
    where there is no such text."""
    chunks = cut_lineage(_chunks(documents, key, text, size))
    if chunks.isEmpty():
        return None
    ahead = _ahead_of(chunks)

    def units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, own, no, start, low, high, last, beyond, body, before, entry in zip(*(c.to_pylist() for c in batch.columns)):
                cuts = set(chunk_boundaries(body, low, high, int(np.frombuffer(before, np.int16)[entry]), beyond))
                cuts = sorted(cuts | ({0} if start + low == 0 else set()) | ({len(body)} if last else set()))
                if not cuts:
                    continue
                ends = [len(body[:at].rstrip()) if at == len(body) else _blank_ends(body, 0, at)[1] for at in cuts]
                begins = [at + len(_AFTER.match(body, at)[0]) for at in cuts]
                out += [(row, own, no, False, start + a, start + b) for a, b in zip(begins, ends[1:]) if a < b]
                out.append((row, own, no, True, start + begins[-1], start + ends[0]))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names=["row", "key", "no", "edge", "start_char", "end_char"])

    entered = ahead.join(_entered(ahead), ["row", "no"]).select("row", "key", "no", "start", "low", "high", "last", "beyond", "body", "before", "entry")
    found = cut_lineage(entered.mapInArrow(units, "row bigint, key bigint, no int, edge boolean, start_char bigint, end_char bigint"))
    # Of each chunk with a boundary one row tells where its last unit begins and where the one it was entered in ends.
    edges = found.where("edge").withColumn("begin", F.lag("start_char").over(Window.partitionBy("row").orderBy("no")))
    across = edges.where(F.col("begin") < F.col("end_char")).select("key", F.col("begin").alias("start_char"), "end_char")
    return found.where("not edge").select("key", "start_char", "end_char").unionByName(across).withColumnRenamed("key", key)


def short_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, start_char, end_char) of the texts of at most ``size`` characters: one pass over the rows, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, ends = [], [], []
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                spans = sentence_spans(body.as_py())
                keys += [own] * len(spans)
                starts += [a for a, _ in spans]
                ends += [b for _, b in spans]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, ends)], names=["key", "start_char", "end_char"])

    short = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("_t")).where(F.col("key").isNotNull() & F.col("_t").isNotNull() & (F.char_length("_t") <= size))
    return short.mapInArrow(run, "key bigint, start_char bigint, end_char bigint").withColumnRenamed("key", key)


def sentences(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK_CHARS) -> DataFrame:
    """Sentence units of every document: (doc_id, start_char, end_char), offsets in characters, without blanks at the ends.

    Null and blank texts and null keys have no units. Rows are taken to have distinct keys; a repeated key repeats its
    rows. Other columns are not read.
    """
    own = documents.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias(text)).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    long = long_spans(own, key, text, size)
    return short_spans(own, key, text, size) if long is None else short_spans(own, key, text, size).unionByName(long)
