import numpy as np
import pytest

from lectern.llm import sentences as S

CASES = {
    "One here. Two there! Three?": ["One here.", "Two there!", "Three?"],
    "Use e.g. the bolt, the nut, etc. in it. Next etc. Then.": ["Use e.g. the bolt, the nut, etc. in it.", "Next etc.", "Then."],
    "See Fig. 5 and sect. 6 of 2.1.4 or a_b.csv. Yes.": ["See Fig. 5 and sect. 6 of 2.1.4 or a_b.csv.", "Yes."],
    "It ended at 6 p.m. The rig stopped at 7 a.m. on Monday.": ["It ended at 6 p.m.", "The rig stopped at 7 a.m. on Monday."],
    'He says: "Stop. Go on." Then "Did it?" asked she.': ['He says: "Stop. Go on."', 'Then "Did it?" asked she.'],
    "File x (see sect. 6. It was new.) is kept. Done.": ["File x (see sect. 6. It was new.) is kept.", "Done."],
    "It ran ... and fell... After that, more.": ["It ran ... and fell...", "After that, more."],
    "Title\n\nText goes\non here. End": ["Title", "Text goes\non here.", "End"],
    "Steps:\n1) first\n2. Second. More\n- third": ["Steps:", "1) first", "2. Second.", "More", "- third"],
    "Am 303. Prüftag war Nr. 5 z. B. gut. Ja.": ["Am 303. Prüftag war Nr. 5 z. B. gut.", "Ja."],
    "„Ist es fest?“ fragte er. „Ja. Gut.“ Ende.": ["„Ist es fest?“ fragte er.", "„Ja. Gut.“", "Ende."],
    "—¿Va? —preguntó. ¿Por qué? «Paren. Ya.» Fin.": ["—¿Va? —preguntó.", "¿Por qué?", "«Paren. Ya.»", "Fin."],
    "« Est-ce bon ? » demande-t-il. Oui !": ["« Est-ce bon ? » demande-t-il.", "Oui !"],
    "他说：“停。走。”然后断裂吗？！是的。间隙约为34.6千帕……仍在（见5页。新。）内。": ["他说：“停。走。”", "然后断裂吗？！", "是的。", "间隙约为34.6千帕……仍在（见5页。新。）内。"],
    "「動きますか？」と尋ねた。約5回…まだである。": ["「動きますか？」と尋ねた。", "約5回…まだである。"],
    "ทุกคนต้อง ชิ้นส่วน DA-2 ถูก 15 มม. ตามแบบ": ["ทุกคนต้อง", "ชิ้นส่วน DA-2 ถูก 15 มม. ตามแบบ"],
    "कुल 4 कि.मी. के बाद। डॉ. अ ने कहा। क्या?": ["कुल 4 कि.मी. के बाद।", "डॉ. अ ने कहा।", "क्या?"],
    "راجع ص. 5 من الملف. هل صدئ؟ نعم ... وما زال.": ["راجع ص. 5 من الملف.", "هل صدئ؟", "نعم ... وما زال."],
    "It fell.pH rose.The end": ["It fell.pH rose.", "The end"],
    "  \n ": [],
}


@pytest.mark.parametrize("text", CASES)
def test_rules(text):
    assert [text[a:b] for a, b in S.sentence_spans(text)] == CASES[text]


def test_unclosed_quotation_is_none():
    assert len(S.sentence_spans('He said "stop. Then it went. On and on.')) == 3


def through_chunks(text, size):
    """The cuts of a text by chunks alone: closing marks from the end, functions, their composition, emission."""
    edges = S.chunk_edges(text, size)
    pairs = list(zip(edges, edges[1:]))
    beyond, held = [], 0
    for a, b in reversed(pairs):
        beyond.insert(0, held)
        signs, hard = S.closing_marks(text, a, b)
        held = signs if hard else signs | held
    through = S.compose_prefix(np.stack([S.chunk_function(text, a, b, c) for (a, b), c in zip(pairs, beyond)]))
    states = [0, *through[:-1, 0]]
    return {c for (a, b), state, d in zip(pairs, states, beyond) for c in S.chunk_boundaries(text, a, b, state, d)}


@pytest.mark.parametrize("size", [7, 40, 300])
def test_chunks_compose_to_the_whole(size):
    text = " ".join(CASES) + "\n\n" + "\n".join(CASES)
    assert through_chunks(text, size) == set(S.boundaries(text))


def test_long_quotations_and_deep_brackets_are_one_unit():
    quoted = "He said: “" + "It ran. It stopped. " * 5_000 + "” Then he left."
    deep = "It (" + "( " * 40 + "was. New" + " )" * 40 + " or. Not) held. Yes."
    assert len(S.sentence_spans(quoted)) == 2 and len(S.sentence_spans(deep)) == 2
    for text in (quoted, deep, "One." + " " * 20_000 + "Two." + "\n" * 9_000 + "- three " + "(" * 300 + " a. B" + ")" * 300):
        for size in (50, 4_000):
            assert through_chunks(text, size) == set(S.boundaries(text))


def test_prefix_scan_equals_running_through():
    rng = np.random.default_rng(0)
    f = rng.integers(0, S.STATES, (37, S.STATES)).astype(np.int16)
    scanned, state = S.compose_prefix(f), 5
    for row, composed in zip(f, scanned):
        state = row[state]
        assert composed[5] == state


def test_spark_forms_agree(spark):
    long = " ".join(list(CASES) * 6)
    rows = [(1, long, 9), (2, "Short one. Two.", 9), (3, None, 9), (4, " ", 9), (None, "x.", 9), (5, "\n\n".join(list(CASES) * 4), 9), (6, "“" + "It ran. " * 400 + "” he said. End." + " " * 900 + "\n\n \nMore. Yes.", 9), (5, "\n\n".join(list(CASES) * 4), 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key int")
    expected = {(i, a, b) for i, t, _ in rows if t and i for a, b in S.sentence_spans(t)}
    for size in (S.CHUNK_CHARS, 500, 12):
        assert {tuple(r) for r in S.sentences(df, size=size).collect()} == expected
    assert S.sentences(df.limit(0)).count() == 0
