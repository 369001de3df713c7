import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import leaks


@given(st.text("abc", max_size=12), st.text("abcd", max_size=25))
@settings(max_examples=200, deadline=None)
def test_myers_equals_dynamic_programming(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for unit in text:
        new = [0]
        for at, p in enumerate(pattern, 1):
            new.append(min(row[at] + 1, new[at - 1] + 1, row[at - 1] + (p != unit)))
        row = new
        best = min(best, row[-1])
    assert leaks.myers(list(pattern), list(text), 99)[0] == best


def brute(items, docs):
    out = set()
    for item, lang, text in items:
        letters = lang in ("zh", "ja")
        own = leaks.units(leaks.normalise(text or ""), letters)
        n = min(len(own), 20 if letters else 12)
        runs = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for doc, body in docs:
            u = leaks.units(leaks.normalise(body or ""), letters)
            if any(tuple(u[i : i + n]) in runs for i in range(len(u) - n + 1)):
                out.add((item, doc))
    return out


def test_exact_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [(i, "en", " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 11, 12, 13, 40])))) for i in range(40)]
    items += [(100 + i, "zh", "".join(rng.choice("一二三四五六七八九十AB12") for _ in range(rng.choice([5, 20, 45])))) for i in range(10)] + [(200, "en", None), (201, None, "  "), (202, "de", "Größe ﬁnal ﬂach")]
    docs = []
    for d in range(120):
        body = [rng.choice(words) for _ in range(30)]
        item = rng.choice(items)
        cut = (item[2] or "").split() if item[1] != "zh" else [item[2]]
        low = rng.randrange(max(1, len(cut)))
        part = cut[low : low + rng.choice([6, 11, 12, 14, 40])]
        docs.append((d, " ".join(body[:9] + [p.upper() + rng.choice(["", ",", "\u00ad"]) for p in part] + body[9:])))
    docs += [(900, None), (901, ""), (902, "grösse Final flach und GRÖSSE FINAL FLACH"), (903, "word " * 40_000)]
    documents = spark.createDataFrame([(*d, 1, "x") for d in docs + docs[:4]], "doc_id bigint, text string, item_id bigint, errors string")
    evals = spark.createDataFrame([(*i, 3) for i in items + items[:3]], "item_id bigint, lang string, text string, doc_id int")
    got = {tuple(r) for r in leaks.exact_leaks(documents, evals).collect()}
    assert got == brute(items, docs) and len(got) > 60
    before, leaks.ITEM_BYTES = leaks.ITEM_BYTES, 1000
    try:  # items in several parts, one pass each
        assert {tuple(r) for r in leaks.exact_leaks(documents, evals).collect()} == got
    finally:
        leaks.ITEM_BYTES = before
    assert leaks.exact_leaks(documents.limit(0), evals).count() == 0 and leaks.exact_leaks(documents, evals.limit(0)).count() == 0


def test_one_edit_is_found_with_the_budget(spark):
    item = "the bench crew saw a torque peak on the seat rail during cold soak"
    docs = spark.createDataFrame([(1, "Note: " + item.replace("torque", "pressure")), (2, "Note: " + item), (3, "nothing of it")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in leaks.find_leaks(docs, spark.createDataFrame([(7, "en", item)], "item_id bigint, lang string, text string")).collect()}
    assert set(found) == {1, 2} and found[2].errors == 0 and found[1].errors == 1 and found[1].run_units < 12


def least_errors(item, doc, n):
    best = n
    for low in range(len(item) - n + 1):
        row = list(range(n + 1))
        for unit in doc:
            new = [0]
            for at, p in enumerate(item[low : low + n], 1):
                new.append(min(row[at] + 1, new[at - 1] + 1, row[at - 1] + (p != unit)))
            row = new
            best = min(best, row[-1])
    return best


def test_one_edit_is_found_at_every_phase():
    rng = random.Random(5)
    for lang, n, length in (("en", 12, 48), ("en", 12, 11), ("en", 12, 2), ("zh", 20, 45), ("ja", 20, 19)):
        letters = lang != "en"
        item = [chr(0x4E00 + i) if letters else f"w{i}" for i in range(length)]
        glue = "" if letters else " "
        matcher = leaks.Matcher(leaks.build_items([(7, lang, glue.join(item))]))
        need = min(n, length)
        for low in range(length - need + 1):
            for at in range(need):
                for edit in ("change", "drop", "add"):
                    part = item[low : low + need]
                    part[at : at + 1] = {"change": ["X"], "drop": [], "add": [part[at], "X"]}[edit]
                    doc = ["Q"] * 3 + part + ["Q"] * 3
                    wanted = least_errors(item, doc, need)
                    assert wanted <= 1 and matcher.matches(glue.join(doc))[7][0] == wanted
        for _ in range(200):  # two edits, often too many
            low = rng.randrange(length - need + 1)
            part = item[low : low + need]
            part[rng.randrange(need)], part[rng.randrange(need)] = "X", "Y"
            doc = ["Q"] * 3 + part + ["Q"] * 3
            wanted, found = least_errors(item, doc, need), matcher.matches(glue.join(doc))
            assert (found[7][0] == wanted) if wanted <= 1 else not found


def test_rows_come_from_the_distance(spark, monkeypatch):
    item = "the bench crew saw a torque peak on the seat rail during cold soak"
    docs = spark.createDataFrame([(2, "Note: " + item)], "doc_id bigint, text string")
    matcher = leaks.Matcher(leaks.build_items([(7, "en", item)]))
    assert matcher.matches("Note: " + item)[7][0] == 0
    monkeypatch.setattr(leaks, "myers", lambda pattern, text, most: (most + 1, 0))
    assert not matcher.matches("Note: " + item)
