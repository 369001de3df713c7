import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import splitting


def check(text, limit, overlap, pieces):
    end = 0
    for number, start, stop, body in sorted(pieces):
        assert body == text[start:stop] and 0 < stop - start <= limit
        assert start <= end and end - start <= overlap and (number == 0) == (start == 0 and end == 0)
        end = stop
    assert end == len(text)


@given(st.text("ab .\n。é́", min_size=2, max_size=400), st.integers(1, 60), st.integers(0, 40))
@settings(max_examples=150, deadline=None)
def test_windows_tile_any_text(text, limit, overlap):
    overlap, stride, slack = splitting.grid(limit, overlap)
    if len(text) <= limit:
        return
    cuts = []
    for k in range(1, -(-len(text) // stride)):
        low, high = k * stride - slack // 2 - 1, min(len(text) - 1, k * stride + slack - slack // 2)
        cut, _ = splitting.best_cut(text, low, high, k * stride)
        assert low < cut <= max(high, k * stride)
        cuts.append(cut)
    edges = [0, *cuts, len(text)]
    assert edges == sorted(edges)
    for a, b in zip(edges, edges[1:]):
        start = splitting.overlap_start(text, a, overlap) if a else 0
        assert b - start <= limit and a - start <= overlap


def test_natural_boundaries_first():
    text = "word " * 10 + "\n\n" + "word " * 10
    assert splitting.best_cut(text, 30, 70, 60)[1] == "paragraph"
    assert splitting.best_cut("One here. Two there", 2, 15, 8) == (10, "sentence")
    assert splitting.best_cut("a" * 30, 5, 15, 10) == (10, "hard")


@pytest.mark.parametrize("range_chars", [64, 1000, 32768])
def test_ranges_agree_with_the_whole(spark, range_chars):
    rng = random.Random(3)
    rows = []
    for n in range(12):
        text = "".join(rng.choice(["word ", "longer. ", "line\n", "para\n\n", "字。", "xxxxxxxxxxxx"]) for _ in range(rng.randrange(5, 400)))
        rows.append((f"c{n}", text, "p", "table_row" if n % 3 == 0 else "narrative"))
    rows += [("short", "abc", "p", "narrative"), ("null", None, "p", "narrative"), ("other", "x" * 999, "unknown", "narrative"), ("c1", rows[1][1], "p", "narrative"), ("default", "y " * 2000, None, "narrative"), (None, "z" * 999, "p", "narrative")]
    chunks = spark.createDataFrame(rows, "chunk_id string, content_text string, policy_version string, chunk_type string")
    chunks = chunks.selectExpr("*", "1 AS key", "2 AS k", "3 AS body")
    policies = spark.createDataFrame([("p", 90, 20, 130), ("canonical-chunks-v2", 1800, 320, 3000)], "policy_version string, max_chunk_characters int, max_overlap_characters int, max_table_row_characters int")
    over = splitting.oversized(chunks, policies)
    got = {}
    for r in splitting.pieces(over, range_chars=range_chars).collect():
        got.setdefault(r.chunk_id, []).append((r.piece_no, r.start_char, r.end_char, r.piece_text))
    texts = {r[0]: r for r in rows}
    wanted = {name for name, text, policy, kind in rows if name and text and policy != "unknown" and len(text) > ((130 if kind == "table_row" else 90) if policy else 1800)}
    assert set(got) == wanted == {r.chunk_id for r in splitting.oversized_keys(over, range_chars=range_chars).collect()}
    for name, pieces in got.items():
        _, text, policy, kind = texts[name]
        check(text, (130 if kind == "table_row" else 90) if policy else 1800, 20 if policy else 320, pieces)
    assert splitting.pieces(over.limit(0)).count() == 0


def whole(text, limit, overlap):
    """The pieces by best_cut on the whole text, cut after cut."""
    overlap = splitting.grid(limit, overlap)[0]
    out, cut, start = [], 0, 0
    while len(text) - start > limit:
        low, high = cut, start + limit
        cut, kind = splitting.best_cut(text, low, high, high)
        out.append((len(out), start, cut, low - start, kind))
        start = splitting.overlap_start(text, cut, overlap)
    return [*out, (len(out), start, len(text), cut - start, "end")]


@given(st.lists(st.sampled_from(["word ", "longer. ", "line\n", "para\n\n", "字。", "字", "xxxxxxxxxxxx", "é", "-"]), min_size=5, max_size=150), st.integers(20, 60), st.integers(0, 40), st.integers(16, 200))
@settings(max_examples=300, deadline=None)
def test_stitched_cuts_equal_the_best_of_each_span(parts, limit, overlap, size):
    text = "".join(parts)
    if len(text) <= limit:
        return
    own, stride, slack = splitting.grid(limit, overlap)
    chain, got = splitting.Chain(limit, len(text)), []
    for first in range(0, len(text), size):
        last, start = min(len(text), first + size), max(0, first - 2 * limit)
        body = text[start : last + 2 * limit]
        found = splitting.boundaries(body, first - start, last - start, stride + slack)
        got += chain.feed([at + start for at, _ in found], [splitting.overlap_start(body, at, own) + start for at, _ in found], [rank for _, rank in found], last)
    assert got == whole(text, limit, overlap)


def test_boundaries_anywhere_in_the_span_are_used(spark):
    text = "a" * 40 + "\n\n" + "b" * 50 + ". " + "c" * 45 + "\n" + "d" * 70
    texts = spark.createDataFrame([("k", text, len(text), 100, 0)], "chunk_id string, content_text string, n_chars int, limit_chars int, overlap_chars int")
    got = [(r.end_char, r.cut_kind) for r in splitting.pieces(texts).orderBy("piece_no").collect()]
    assert got == [(42, "paragraph"), (140, "line"), (210, "end")]


def test_files_by_byte_ranges_equal_texts_at_hand(spark, tmp_path):
    rng = random.Random(3)
    words = ["torque", "Dichtung", "座席轨道", "แรงบิด", "naïve", "🙂", "e\u0301", "क्षमता", "x" * 90]
    bodies = ["".join(rng.choice(words) + rng.choice([" ", ". ", "\n", "\n\n", "。", ""]) for _ in range(n)) for n in (900, 40, 3)] + ["", "y" * 700]
    for no, body in enumerate(bodies):
        (tmp_path / f"{no}.txt").write_bytes(body.encode())
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length")
    limit, overlap = 120, 30
    texts = spark.createDataFrame([(str(no), body, limit, overlap) for no, body in enumerate(bodies) if body], "chunk_id string, content_text string, limit_chars int, overlap_chars int")
    columns = ("piece_no", "start_char", "end_char", "overlap_chars", "cut_kind", "piece_text")
    wanted = {(r.chunk_id, *(r[c] for c in columns)) for r in splitting.pieces(texts).collect()}
    for range_bytes in (64, 1_000, 1_000_000):
        got = {(r.path.rpartition("/")[2][:-4], *(r[c] for c in columns)) for r in splitting.split_files(files, limit, overlap, range_bytes).collect()}
        assert got == wanted


@given(st.text("ab .!。”\n é\u0301", max_size=120), st.integers(0, 30))
@settings(max_examples=300, deadline=None)
def test_overlap_starts_of_many_cuts(text, overlap):
    cuts = list(range(1, len(text)))
    assert splitting.overlap_starts(text, cuts, overlap) == [splitting.overlap_start(text, at, overlap) for at in cuts]
