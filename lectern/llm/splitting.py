"""Splitting of oversized texts at natural boundaries, by ranges.

A text is never handled as a whole. It is cut into ranges; each range, read with a halo on both sides, finds the boundaries
that lie in it. The boundary tables of a text's ranges are stitched in order, which chooses the cuts and gives each piece its
offsets; the pieces are then emitted range by range, from the text of one range and its halo. Texts of any length spread over
as many tasks as they have ranges; what one task goes through in order is the boundary table alone, range after range.

The cuts. A piece starts up to the overlap before its cut and may be as long as the limit; the next cut is the best boundary
between its own cut and that end, of the best class the last one. Boundaries rank: blank line, line end, sentence end, clause
end, space, script change (where a text without blanks allows a break), and only then any character that doesn't part a
character from its marks. :func:`best_cut` is that choice on a text at hand. A boundary that has a better one less than
limit - overlap before the next that is at least as good can never be chosen, and is left out of the tables.

:func:`split_files` does the same for files too large to load: its ranges are byte ranges, read at their offsets.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.plans.lineage import broadcast_checked, cut

#: Policy of rows without one, and the kind of chunk that has a limit of its own (fixed values).
DEFAULT_POLICY, TABLE_ROW = "canonical-chunks-v2", "table_row"
#: Characters of a range.
RANGE_CHARS = 32_768

#: Boundary classes, best first. A cut falls at the end of the match.
_CLASSES = (
    ("paragraph", re.compile(r"\n[ \t\r]*\n\s*")),
    ("line", re.compile(r"\n[ \t]*")),
    ("sentence", re.compile(r"(?:[.!?…]+[\"'”’»)\]]*\s+)|(?:[。！？｡।؟۔]+[”’」』）】]*\s*)")),
    ("clause", re.compile(r"(?:[;:,|،؛]\s+)|(?:[；：，、]\s*)|(?:\s[–—-]\s)")),
    ("space", re.compile(r"\s+")),
)
RANKS = {name: at for at, (name, _) in enumerate(_CLASSES)} | {"script": 5, "hard": 6}


def _joined(before: str, after: str) -> bool:
    """Whether a cut between the two characters would part a character from its marks."""
    return unicodedata.combining(after) != 0 or unicodedata.category(after) in ("Mn", "Mc", "Me") or after in "\u200d\ufe0f" or before == "\u200d"


def _letters(a: str, b: str) -> bool:
    return a.isalnum() and b.isalnum() and (ord(a) < 0x2E80 or ord(b) < 0x2E80)


def best_cut(text: str, low: int, high: int, aim: int) -> tuple[int, str]:
    """The position p in (low, high] at which to cut ``text``, and its class: of the best class, the one nearest ``aim``."""
    for name, pattern in _CLASSES:
        best = None
        for met in pattern.finditer(text, max(0, low - 8), min(len(text), high + 8)):
            at = met.end()
            if low < at <= high and (best is None or abs(at - aim) < abs(best - aim)):
                best = at
        if best is not None:
            return best, name
    for away in range(max(high - aim, aim - low) + 1):  # no blank at all: where a script allows a break, nearest first
        for at in (aim - away, aim + away):
            if low < at <= high and 0 < at < len(text) and not _joined(text[at - 1], text[at]) and not _letters(text[at - 1], text[at]):
                return at, "script"
    for away in range(max(high - aim, aim - low) + 1):
        for at in (aim - away, aim + away):
            if low < at <= high and 0 < at < len(text) and not _joined(text[at - 1], text[at]):
                return at, "hard"
    return min(aim, high), "hard"


def grid(limit: int, overlap: int) -> tuple[int, int, int]:
    """(overlap, stride, slack) for a limit of at least 1; an overlap of more than half the limit counts as half."""
    overlap = max(0, min(overlap, limit // 2))
    room = limit - overlap
    stride = max(1, room * 3 // 4)
    return overlap, stride, room - stride


def overlap_start(text: str, cut: int, overlap: int) -> int:
    """Where the piece that follows a cut begins: the first sentence or else word within ``overlap`` before the cut."""
    if overlap <= 0:
        return cut
    for name in ("sentence", "space"):
        for met in _CLASSES[RANKS[name]][1].finditer(text, max(0, cut - overlap), cut):
            if cut - overlap <= met.end() < cut:
                return met.end()
    return _unjoined(text, max(0, cut - overlap), cut)


_SENTENCE_PARTS = re.compile(r"([.!?…]+)[\"'”’»)\]]*\s+|([。！？｡।؟۔]+)[”’」』）】]*\s*")


def overlap_starts(text: str, cuts: list[int], overlap: int) -> list[int]:
    """:func:`overlap_start` of many cuts, with one look for the sentence ends and blanks of the text."""
    if overlap <= 0:
        return list(cuts)
    marks, ends = [], []
    for met in _SENTENCE_PARTS.finditer(text):
        marks.append(met.end(met.lastindex) - 1)
        ends.append(met.end())
    blanks = [met.end() for met in _CLASSES[RANKS["space"]][1].finditer(text)]
    out = []
    for at in cuts:
        low = max(0, at - overlap)
        no = bisect_left(marks, low)
        if no < len(ends) and ends[no] < at:
            out.append(ends[no])
            continue
        no = bisect_right(blanks, low)
        out.append(blanks[no] if no < len(blanks) and blanks[no] < at else _unjoined(text, low, at))
    return out


def _unjoined(text: str, start: int, cut: int) -> int:
    while start < cut and start > 0 and _joined(text[start - 1], text[start]):
        start += 1
    return start


def oversized(chunks: DataFrame, policies: DataFrame, key: str = "chunk_id", text: str = "content_text") -> DataFrame:
    """(key, text, n_chars, limit_chars, overlap_chars) of the rows that are longer than their limit.

    A null policy means ``DEFAULT_POLICY``; rows with a null text or a policy that isn't in ``policies`` have no limit and
    no row here. ``policies`` is a table of a few rows, fixed by its nature, and is broadcast after its size is checked.
    """
    limits = policies.select(F.col("policy_version").alias("_policy"), F.col("max_chunk_characters").alias("_chunk"), F.col("max_table_row_characters").alias("_row"), F.col("max_overlap_characters").alias("_overlap")).dropDuplicates(["_policy"])
    own = chunks.select(F.col(key), F.col(text), F.coalesce("policy_version", F.lit(DEFAULT_POLICY)).alias("_policy"), F.col("chunk_type").alias("_type")).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    joined = own.join(broadcast_checked(limits), "_policy").withColumn("limit_chars", F.when(F.col("_type") == TABLE_ROW, F.col("_row")).otherwise(F.col("_chunk"))).withColumn("n_chars", F.char_length(text))
    return joined.where((F.col("limit_chars") > 0) & (F.col("n_chars") > F.col("limit_chars"))).select(key, text, "n_chars", "limit_chars", F.coalesce("_overlap", F.lit(0)).alias("overlap_chars"))


def boundaries(body: str, first: int, last: int, room: int) -> list[tuple[int, int]]:
    """(position, rank) of the boundaries in (first, last] of ``body`` that a cut may fall on, in order.

    Beyond either end of ``body`` there may be any boundary or none, so what depends on that is kept.
    """
    ranks: dict[int, int] = {}
    for rank, (_, pattern) in enumerate(_CLASSES):
        for met in pattern.finditer(body):
            if 0 < met.end() < len(body):
                ranks.setdefault(met.end(), rank)
    places = sorted(ranks)
    for rank in (RANKS["script"], RANKS["hard"]):  # only where a whole span may hold no better boundary
        for low, high in zip([-1 - room, *places], [*places, len(body) + room]):
            if high - low > room:
                for at in range(max(low, first) + 1, min(high, last + 1, len(body))):
                    if at > 0 and not _joined(body[at - 1], body[at]) and (rank == RANKS["hard"] or not _letters(body[at - 1], body[at])):
                        ranks[at] = rank
        places = sorted(ranks) if len(ranks) > len(places) else places
    nexts, stack = [len(body) + 2 * room] * len(places), []  # of each boundary the next one that is at least as good
    for no, at in enumerate(places):
        while stack and ranks[at] <= ranks[places[stack[-1]]]:
            nexts[stack.pop()] = at
        stack.append(no)
    found, stack = [], []
    for no, at in enumerate(places):
        while stack and ranks[stack[-1]] >= ranks[at]:
            stack.pop()
        better = stack[-1] if stack else -1 - room
        stack.append(at)
        if first < at <= last and nexts[no] - better > room:
            found.append((at, ranks[at]))
    return found


def _spans(size: int, limit: int, range_chars: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(no, first, last, start, end) of the ranges of a text: the boundaries in (first, last] belong to a range, which is read
    from ``start`` to ``end``, with a halo of two limits before and after it."""
    for no, first in enumerate(range(0, size, range_chars)):
        last = min(size, first + range_chars)
        yield no, first, last, max(0, first - 2 * limit), min(size, last + 2 * limit)


def ranges(texts: DataFrame, key: str = "chunk_id", text: str = "content_text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """(key, range_no, start, body): each range of a text with its halos; ``start`` is the offset of ``body``. Each text is
    gone through once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, limit, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                whole = body.as_py()
                for no, _, _, start, end in _spans(len(whole), limit, range_chars):
                    yield pa.RecordBatch.from_arrays([pa.array([own], pa.string()), pa.array([no], pa.int32()), pa.array([start], pa.int64()), pa.array([whole[start:end]], pa.string())], names=["key", "range_no", "start", "body"])

    return texts.select(F.col(key).cast("string"), "limit_chars", F.col(text)).mapInArrow(run, "key string, range_no int, start bigint, body string")


_TABLE = (("key", "string", pa.string()), ("range_no", "int", pa.int32()), ("limit_chars", "int", pa.int32()), ("n_chars", "bigint", pa.int64()), ("last", "bigint", pa.int64()), ("cuts", "array<bigint>", pa.list_(pa.int64())), ("starts", "array<bigint>", pa.list_(pa.int64())), ("ranks", "array<int>", pa.list_(pa.int32())))


def range_table(body: str, first: int, last: int, limit: int, overlap: int) -> tuple[list[int], list[int], list[int]]:
    """Of the range (first, last] of ``body``: where cuts may fall, where the piece after each would start, the rank of each."""
    overlap, stride, slack = grid(limit, overlap)
    found = boundaries(body, first, last, stride + slack)
    return [at for at, _ in found], overlap_starts(body, [at for at, _ in found], overlap), [rank for _, rank in found]


def find_cuts(texts: DataFrame, key: str = "chunk_id", text: str = "content_text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """The boundary tables: (key, range_no, limit_chars, n_chars, last, cuts, starts, ranks), one row per range."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, limit, overlap, body in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                whole = body.as_py()
                for no, first, last, start, end in _spans(len(whole), limit, range_chars):
                    cuts, starts, ranks = range_table(whole[start:end], first - start, last - start, limit, overlap)
                    rows.append((own, no, limit, len(whole), last, [at + start for at in cuts], [at + start for at in starts], ranks))
            yield pa.RecordBatch.from_arrays([pa.array([r[at] for r in rows], kind) for at, (_, _, kind) in enumerate(_TABLE)], names=[name for name, _, _ in _TABLE])

    return texts.select(F.col(key).cast("string"), "limit_chars", "overlap_chars", F.col(text)).mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in _TABLE))


class Chain:
    """The pieces of one text, from its boundary tables in order; holds the boundaries of about one span at a time."""

    def __init__(self, limit: int, size: int):
        self.limit, self.size = limit, size
        self.cut = self.start = self.number = 0
        self.places: list[int] = []
        self.starts: list[int] = []
        self.ranks: list[int] = []

    def feed(self, cuts: list[int], starts: list[int], ranks: list[int], known: int) -> Iterator[tuple[int, int, int, int, str]]:
        """(piece_no, start_char, end_char, overlap_chars, cut_kind) of the pieces that boundaries up to ``known`` settle."""
        self.places += cuts
        self.starts += starts
        self.ranks += ranks
        done = 0
        while self.size - self.start > self.limit and self.start + self.limit <= known:
            high = self.start + self.limit
            low, end = bisect_right(self.places, self.cut, done), bisect_right(self.places, high, done)
            best = min(range(low, end), key=lambda at: (self.ranks[at], -at), default=None)
            cut, start, kind = (high, high, "hard") if best is None else (self.places[best], self.starts[best], _KINDS[self.ranks[best]])
            yield self.number, self.start, cut, self.cut - self.start, kind
            self.number, self.cut, self.start, done = self.number + 1, cut, start, low
        del self.places[:done], self.starts[:done], self.ranks[:done]
        if known == self.size:
            yield self.number, self.start, self.size, self.cut - self.start, "end"


_KINDS = {rank: name for name, rank in RANKS.items()}
_PIECE = (("key", "string", pa.string()), ("range_no", "int", pa.int32()), ("piece_no", "int", pa.int32()), ("start_char", "bigint", pa.int64()), ("end_char", "bigint", pa.int64()), ("overlap_chars", "bigint", pa.int64()), ("cut_kind", "string", pa.string()))


def stitch(cuts: DataFrame) -> DataFrame:
    """Piece offsets from the boundary tables of all ranges: (key, range_no, piece_no, start_char, end_char, overlap_chars,
    cut_kind); ``range_no`` is the range a piece ends in.

    Piece 0 starts at 0; piece n starts up to the overlap before cut n and ends at cut n + 1, the last one at the end. The
    ranges of a text come in order to one task, which passes through them once; a repeated range counts once.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, chain, ends = None, -1, None, []
        for batch in batches:
            rows = []
            for key, no, limit, size, last, places, starts, ranks in zip(*(c.to_pylist() for c in batch.columns)):
                if key != own:
                    own, seen, chain, ends = key, -1, Chain(limit, size), []
                if no == seen:
                    continue
                seen = no
                ends.append((last, no))
                for piece in chain.feed(places, starts, ranks, last):
                    del ends[: bisect_left(ends, (piece[2], -1))]
                    rows.append((key, ends[0][1], *piece))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[at] for r in rows], kind) for at, (_, _, kind) in enumerate(_PIECE)], names=[name for name, _, _ in _PIECE])

    parts = int(cuts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cuts.repartition(parts, "key").sortWithinPartitions("key", "range_no").mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in _PIECE))


def pieces(texts: DataFrame, key: str = "chunk_id", text: str = "content_text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """Every oversized text of ``texts`` (the columns of :func:`oversized`) as pieces:
    (key, piece_no, start_char, end_char, overlap_chars, cut_kind, piece_text).

    Each piece is at most ``limit_chars`` long; the pieces cover the text without gaps; consecutive ones share at most
    ``overlap_chars``. A repeated delivery counts once. Each piece is cut out of the one range it ends in.
    """
    offsets = stitch(find_cuts(texts, key, text, range_chars))
    bodies = ranges(texts, key, text, range_chars).dropDuplicates(["key", "range_no"])
    joined = offsets.join(bodies, ["key", "range_no"])
    return joined.select(F.col("key").alias(key), "piece_no", "start_char", "end_char", "overlap_chars", "cut_kind", F.substring("body", (F.col("start_char") - F.col("start") + 1).cast("int"), (F.col("end_char") - F.col("start_char")).cast("int")).alias("piece_text"))


def oversized_keys(texts: DataFrame, key: str = "chunk_id", text: str = "content_text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """The keys of the texts that :func:`pieces` cuts, as a set: those with a stitched piece beyond the first."""
    offsets = stitch(find_cuts(texts, key, text, range_chars))
    return offsets.where(F.col("piece_no") == 1).select(F.col("key").alias(key))


# ---- giant files: byte ranges ----


def open_file(path: str):
    """A file to read at offsets, on whatever file system the path names."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path) if re.match(r"[a-z0-9]+:", path) else f"file://{path}")
    return system.open_input_file(inner)


def _read(source, low: int, high: int, size: int) -> tuple[bytes, int]:
    """The bytes of [low, high) of a UTF-8 file, moved to the starts of characters, and the offset of the first."""
    source.seek(low)
    raw = source.read(min(size, high + 3) - low)
    skip = 0
    while low and skip < 3 and skip < len(raw) and raw[skip] & 0xC0 == 0x80:
        skip += 1
    end = high - low
    while high < size and end < len(raw) and end < high - low + 3 and raw[end] & 0xC0 == 0x80:
        end += 1
    return raw[skip:end], low + skip


def file_ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """(path, range_no, first_byte, last_byte, n_bytes) of files (path, length), spread over all tasks. No content is read."""
    split = files.select("path", F.col("length").alias("n_bytes")).where("path IS NOT NULL AND length > 0").withColumn("range_no", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_bytes") - 1) / range_bytes).cast("int"))))
    first = F.col("range_no").cast("bigint") * range_bytes
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return split.select("path", "range_no", first.alias("first_byte"), F.least("n_bytes", first + range_bytes).alias("last_byte"), "n_bytes").repartition(parts, "path", "range_no")


def split_files(files: DataFrame, limit: int, overlap: int = 0, range_bytes: int = 8_388_608, opener: Callable = open_file) -> DataFrame:
    """Pieces of text files of any size: (path, piece_no, start_char, end_char, overlap_chars, cut_kind, piece_text).

    ``files``: (path, length) as Spark's binaryFile source lists them; files in UTF-8, a byte that isn't counts as one
    character. Workers read byte ranges with halos and find their boundaries and their number of characters; prefix sums of
    these give each range its offset in characters; the tables are stitched, and the pieces are emitted from the byte range
    they end in. No file is ever loaded as a whole; a file without characters has no piece.
    """
    halo = 4 * 2 * limit + 8
    spans = cut(file_ranges(files, range_bytes))
    schema = pa.schema([("path", pa.string()), ("range_no", pa.int32()), ("own_chars", pa.int64()), ("cuts", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))])

    def body_of(source, first: int, last: int, size: int) -> tuple[str, int, int]:
        """The range with its halos as text, and where its own characters begin and end in it."""
        before, _ = _read(source, max(0, first - halo), first, size)
        own, _ = _read(source, first, last, size)
        after, _ = _read(source, last, min(size, last + halo), size) if last < size else (b"", 0)
        before, own, after = (x.decode("utf-8", "replace") for x in (before, own, after))
        return before + own + after, len(before), len(before) + len(own)

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, no, first, last, size in zip(*(c.to_pylist() for c in batch.columns)):
                with opener(path) as source:
                    body, low, high = body_of(source, first, last, size)
                cuts, starts, ranks = range_table(body, low, high, limit, overlap)
                values = (path, no, high - low, [at - low for at in cuts], [at - low for at in starts], ranks)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    found = cut(spans.mapInArrow(tables, "path string, range_no int, own_chars bigint, cuts array<bigint>, starts array<bigint>, ranks array<int>"))
    order = Window.partitionBy("path").orderBy("range_no")
    placed = found.withColumn("last", F.sum("own_chars").over(order)).withColumn("n_chars", F.sum("own_chars").over(Window.partitionBy("path"))).withColumn("offset", F.col("last") - F.col("own_chars"))
    shifted = lambda name: F.transform(name, lambda x: x + F.col("offset"))
    offsets = stitch(placed.where("n_chars > 0").select(F.col("path").alias("key"), "range_no", F.lit(limit).alias("limit_chars"), "n_chars", "last", shifted("cuts").alias("cuts"), shifted("starts").alias("starts"), "ranks"))

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, body, low = None, "", 0
        for batch in batches:
            texts = []
            for path, no, start, end, offset, first, last, size in zip(*(batch.column(n).to_pylist() for n in ("key", "range_no", "start_char", "end_char", "offset", "first_byte", "last_byte", "n_bytes"))):
                if held != (path, no):
                    with opener(path) as source:
                        body, low, _ = body_of(source, first, last, size)
                    held = (path, no)
                texts.append(body[start - offset + low : end - offset + low])
            names = ["key", "piece_no", "start_char", "end_char", "overlap_chars", "cut_kind"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "piece_text"])

    begins = placed.select(F.col("path").alias("key"), "range_no", "offset")
    bytes_of = spans.select(F.col("path").alias("key"), "range_no", "first_byte", "last_byte", "n_bytes")
    located = offsets.join(begins, ["key", "range_no"]).join(bytes_of, ["key", "range_no"]).sortWithinPartitions("key", "range_no")
    return located.mapInArrow(emit, "key string, piece_no int, start_char bigint, end_char bigint, overlap_chars bigint, cut_kind string, piece_text string").withColumnRenamed("key", "path")
