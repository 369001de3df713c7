import random

import numpy as np
import pytest

from lectern.llm import neardup

SCHEMA = "chunk_id string, content_text string, embedding_text string, sig bigint, prefix string"


def sample(seed=1, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([3, 4, 8, 30, 60]))]
        rows.append((f"a{i:03}", " ".join(base)))
        for j in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((f"b{i:03}{j}", " ".join(copy).title() + "!"))
    return rows


def brute(rows, words=3, least=0.7):
    sets = {}
    for name, text in rows:
        own = neardup._WORD.findall((text or "").lower())
        if len(own) >= words:
            sets[name] = {tuple(own[i : i + words]) for i in range(len(own) - words + 1)}
    names = sorted(sets)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}


def frame(spark, rows):
    return spark.createDataFrame([(n, t, None, 1, "p") for n, t in rows], SCHEMA)


@pytest.mark.parametrize("block_texts", [4096, 3])
def test_pairs_equal_brute_force(spark, monkeypatch, block_texts):
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", block_texts)
    rows = sample()
    df = frame(spark, rows + rows[:5] + [("n1", None), ("n2", ""), ("n3", "two words"), (None, rows[0][1])])
    got = {tuple(r) for r in neardup.similar_pairs(df).collect()}
    assert got == brute(rows) and len(got) > 20


def test_other_widths(spark):
    rows = sample(2, 60)
    got = {tuple(r) for r in neardup.similar_pairs(frame(spark, rows), similarity=0.8, words=5).collect()}
    assert got == brute(rows, 5, 0.8)


def test_groups_are_components(spark):
    rows = sample(5, 60)
    pairs = brute(rows)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    links = {}
    for a, b in pairs:
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    expected = {(n, root(n), k) for n, k in links.items()}
    assert {tuple(r) for r in neardup.groups(frame(spark, rows)).collect()} == expected


def test_embedding_text_stands_in(spark):
    rows = [("x", None, "Document: d\nContext: c\nContent: one two three four five", 1, ""), ("y", "One two, three four five", None, 1, ""), ("z", None, "no label here at all", 1, "")]
    assert [tuple(r) for r in neardup.similar_pairs(spark.createDataFrame(rows, SCHEMA)).collect()] == [("x", "y")]


def test_hot_text_and_empty_table(spark):
    rows = [(f"h{i:02}", "the same text for a third of all rows") for i in range(30)]
    assert neardup.similar_pairs(frame(spark, rows)).count() == 435
    assert neardup.similar_pairs(frame(spark, rows).limit(0)).count() == 0 and neardup.groups(frame(spark, rows).limit(0)).count() == 0


def test_bit_sliced_counts_equal_popcounts():
    rng = np.random.default_rng(0)
    sketch = rng.integers(0, 1 << 63, (150, 2), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (150, 2), dtype=np.uint64)
    sketch[100:] = sketch[:50]
    sketch[100:, 0] ^= np.uint64(0b1011)
    block, lane = np.arange(150) // 64, np.arange(150) % 64
    planes = neardup._transpose(sketch, block, lane, 3)
    q = np.repeat(np.arange(150), 3)
    b = np.tile(np.arange(3), 150)
    alive, lanes = neardup.bit_sliced_matches(planes, q, b, sketch, 40)
    got = {(int(q[a]), int(b[a]) * 64 + at) for a, word in zip(alive, lanes) for at in range(64) if int(word) >> at & 1 and int(b[a]) * 64 + at < 150}
    distance = lambda x, y: sum(int(a ^ c).bit_count() for a, c in zip(map(int, sketch[x]), map(int, sketch[y])))
    assert got == {(x, y) for x in range(150) for y in range(150) if distance(x, y) <= 40}
