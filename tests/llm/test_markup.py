from collections import Counter

import pytest

from lectern.llm import markup


def units(text):
    return Counter(kind for kind, _ in markup.structure_units(text))


@pytest.mark.parametrize("text", [None, "", "  \n", "Parts cost $40 each, later $15 each.", "If p < 3 and q > 2, it stays.", "Run a * b, then c * d.", "The C# tool and pin #4.", "Copy at \\\\plant401\\tests\\run was lost.", "R&D checked it; A->B was fine. Ratio 3:2 == fine.", "Use x_1 and x_2; 100% | 50% were seen.", "[see note 9] and [AB-12] (spare), about ~12 volts {sic}.", "It's the lab's 'front' seat, not o'clock 5.", "(<58 ohms) and (>17 hours)"])
def test_plain_text_has_no_markup(text):
    assert markup.structure_units(text) == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("# One\n\ntext\n\nTwo\n===\n\nThree\n---\n", {"heading": 3}),
        ("== One ==\n\n* a\n** b\n# c\n# d", {"heading": 1, "list_item": 4}),
        ("\\section{One}\n\\begin{itemize}\n\\item a\n\\item[--] b\n\\end{itemize}", {"heading": 1, "list_item": 2}),
        ("<html><body><h2\n class='x'><b>One</b></h2><ul><li>a<ul><li>b</ul><li>c</ul></body></html>", {"heading": 1, "list_item": 3}),
        ("```python\n# no heading\n- no item\n```\n\n~~~\n$x$\n~~~", {"code_block": 2}),
        ("text\n\n    # reset\n    - 1\n\nmore `# code` here", {"code_block": 1}),
        ("<pre><code># a\n- b</code></pre> <nowiki>== no ==</nowiki> <!-- <h1>no</h1> -->", {"code_block": 1}),
        ("\\begin{verbatim}\n\\section{no}\n$x$\n\\end{verbatim}\n% \\section{no}", {"code_block": 1}),
        ("a $x = 1$ b $$y$$ c \\(z\\) \\[w\\]\n\n\\begin{align*}\na\n\\end{align*} <math>q</math>", {"formula": 6}),
        ("\\# not one\n\n\\* not one", {}),
        ("- [ ] task\n1. one\n    2) nested", {"list_item": 3}),
        ("**bold** only", {}),
        ("&nbsp;x", {}),
    ],
)
def test_units_by_dialect(text, expected):
    assert units(text) == Counter({"markup": 1} | expected)


def test_clean_text_keeps_structure():
    text = "<html><head><style>p {}</style></head><body>\n\n<h1>Top &amp; more</h1>\n\n<p>See <a href='u'>this</a>.</p>\n\n<pre>a &lt; b</pre>\n\n<ul><li>one</li></ul>\n</body></html>\n\n* two\n\n$$x$$"
    clean, counts, _, _ = markup.clean_text(text)
    assert "# Top & more" in clean and "See this." in clean and "```\na < b\n```" in clean
    assert "- one" in clean and "- two" in clean and "$$x$$" in clean and "<" not in clean.replace("a < b", "")
    assert counts == {"heading": 1, "list_item": 2, "code_block": 1, "formula": 1}


def test_smoothing_and_threshold():
    assert markup.smoothed([1.0] * 5) == pytest.approx([1.0] * 5)
    assert 2 < markup.threshold([1, 1, 2, 10, 11]) < 10
    assert markup.threshold([]) == 0.0


def test_spark_forms(spark):
    rows = [(1, "# a\n\n- b", "x"), (1, "# a\n\n- b", "y"), (2, None, "z"), (3, "plain " * 50_000, "z"), (None, "# c", "z")]
    df = spark.createDataFrame(rows, "extraction_id bigint, markdown string, unit_kind string")
    assert sorted(map(tuple, markup.units(df).collect())) == [(1, "heading", 1), (1, "list_item", 1), (1, "markup", 1)]
    clean = {r.extraction_id: r for r in markup.clean(df).collect()}
    assert set(clean) == {1, 2, 3} and clean[2].clean_text == "" and clean[1].n_headings == 1
    assert markup.units(df.limit(0)).count() == 0 and markup.clean(df.limit(0)).count() == 0


def test_short_plain_lines_stay_in_mixed_records():
    long = "This is a long line of plain prose, one that goes on and on about torque and seat rails. " * 4
    short = ["扭矩过高", "ok", "key value", "| a | b |", "แรงบิดสูง"]
    text = "\n".join([long] * 6 + ["<b>x</b>"] + short + [long] * 6)
    clean, _, _, _ = markup.clean_text(text)
    assert all(line.strip(" |").split(" | ")[0] in clean for line in short)
    tagged = "\n".join([long] * 6 + ["<i>座椅导轨的扭矩在冷浸期间</i><b>过</b><i>高</i>"] * 3 + [long] * 6)
    assert "座椅导轨的扭矩在冷浸期间" in markup.clean_text(tagged)[0]


def test_menus_go_by_ratio_alone(monkeypatch):
    prose = "<p>The bench crew saw a torque peak on the seat rail during the cold soak, and it went on for an hour.</p>"
    menu = "<a href='a'>Home</a> <a href='b'>Shop</a> <a href='c'>Help</a> <a href='d'>Jobs</a>"
    text = "\n".join([menu] * 9 + [prose] * 6 + [menu] * 9)
    assert markup.clean_text(text)[0].count("Home") <= 4 and markup.clean_text(text)[0].count("torque peak") == 6
    monkeypatch.setattr(markup, "content_lines", lambda parsed: [True] * 24)
    assert markup.clean_text(text)[0].count("Home") == 18
