import pytest

from lectern.llm import mixing

DOCS = "doc_id bigint, text string, source string, n_tokens string, rate int"


def corpus(spark):
    rows = [(i, "word " * (5 + i % 40), ["A", " a", "B ", "b", "A"][i % 5], "x", 1) for i in range(400)]
    rows += [(1000 + i, "tiny text", "c", "x", 1) for i in range(6)] + [(2000, None, "a", "x", 1), (2001, "lost", None, "x", 1), (2002, "lost", "  ", "x", 1)]
    return spark.createDataFrame(rows, DOCS)


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_weight double, max_repeats int")


def test_unreachable_sources(spark):
    t = targets(spark, ("A", 0.3, 4), ("b", 0.3, 4), ("C", 0.4, 3), (None, 0.1, 1), ("absent", 0.1, 9))
    assert {r.source for r in mixing.unreachable(corpus(spark), t).collect()} == {"c", "absent"}


def test_shares_meet_targets_within_a_document(spark):
    t = targets(spark, ("a", 0.2, 4), ("b", 0.8, 6))
    sizes, solved = mixing.solve_exact(corpus(spark), t)
    mixed = mixing.mix(sizes, solved)
    rows = mixed.collect()
    assert {r.source for r in rows} == {"a", "b"} and all(0 <= r.copies <= 6 for r in rows)
    shares = {r.source: r for r in mixing.shares(mixed, solved).collect()}
    assert shares["a"].actual_share == pytest.approx(0.2, abs=0.01) and shares["b"].actual_share == pytest.approx(0.8, abs=0.01)
    for r in rows:  # exponential tilt: the rate follows from source and tokens alone
        assert abs(r.copies - r.rate) < 1 + 1e-6
    assert sorted(map(tuple, mixing.mix(sizes.repartition(7), solved).collect())) == sorted(map(tuple, rows))


def test_capped_sources_are_taken_whole(spark):
    t = targets(spark, ("c", 0.5, 3), ("a", 0.5, 4))
    sizes, solved = mixing.solve(corpus(spark), t)
    assert {r.copies for r in mixing.mix(sizes, solved).where("source = 'c'").collect()} == {3}


def test_tokens_and_empty_tables(spark):
    assert mixing.count_tokens(None) == mixing.count_tokens("") == 0
    text = "several words here " * 3000
    whole = mixing.count_tokens(text)
    assert whole == len(mixing.encoding(mixing.TOKENIZER, mixing.PATTERN).encode_ordinary(text))
    t = targets(spark, ("a", 0.5, 1))
    assert mixing.unreachable(corpus(spark), t.limit(0)).count() == 0
    assert [r.source for r in mixing.unreachable(corpus(spark).limit(0), t).collect()] in ([], ["a"])


def test_unreachable_comes_from_the_dual(spark, monkeypatch):
    t = targets(spark, ("A", 0.3, 4), ("b", 0.3, 4), ("C", 0.4, 3))
    monkeypatch.setattr(mixing, "_newton", lambda histogram, state: state)
    assert mixing.unreachable(corpus(spark), t).count() == 0  # without the iterations nothing is known


def test_more_sources_than_any_bound_and_ties(spark):
    docs = spark.range(25_000).selectExpr("id AS doc_id", "concat('w ', id % 7) AS text", "concat('s', id) AS source")
    t = spark.range(25_000).selectExpr("concat('S', id) AS source", "1e0 / 25000 AS target_weight", "IF(id < 12000, 0, 3) AS max_repeats")
    assert mixing.unreachable(docs, t).count() == 12_000
    two = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y")], "doc_id bigint, text string, source string")
    exact = targets(spark, ("x", 0.5, 1), ("y", 0.5000001, 1))  # x reaches its share with nothing to spare
    assert [r.source for r in mixing.unreachable(two, exact).collect()] == ["y"]
