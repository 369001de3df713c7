import numpy as np

from lectern.llm import neighbours

SCHEMA = "chunk_id string, embedding array<float>, embedding_model string, dimensions int, no int, cell int"


def test_recall_and_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(900, 24))
    near = base[:60] + rng.normal(size=(60, 24)) * 0.05
    x = np.concatenate([base, near]).astype(np.float32) * rng.uniform(0.1, 9, (960, 1)).astype(np.float32)
    rows = [(f"v{i:04}", v.tolist(), "m" if i % 5 else "other", 24, 1, 2) for i, v in enumerate(x)]
    bad = [("null", None, "m", 24, 1, 2), ("zero", [0.0] * 24, "m", 24, 1, 2), ("nan", [float("nan")] + [1.0] * 23, "m", 24, 1, 2), ("inf", [float("inf")] + [1.0] * 23, "m", 24, 1, 2), ("short", [1.0], "m", 24, 1, 2), ("gap", [None] + [1.0] * 23, "m", 24, 1, 2), ("nomodel", [1.0] * 24, None, 24, 1, 2), ("lone", [1.0, 2.0], "single", 2, 1, 2)]
    df = spark.createDataFrame(rows + rows[:9] + bad, SCHEMA)
    got = {}
    for r in neighbours.neighbours(df).collect():
        got.setdefault(r.chunk_id, {})[r.neighbour_id] = r.similarity
    assert set(got) == {r[0] for r in rows} and all(len(v) == 10 for v in got.values())
    hits = pairs = 0
    expected = set()
    for model in ("m", "other"):
        ids = [r[0] for r in rows if r[2] == model]
        u = neighbours.unit(np.array([r[1] for r in rows if r[2] == model]))
        cos = u @ u.T
        np.fill_diagonal(cos, -2)
        for i, name in enumerate(ids):
            top = np.argsort(-cos[i])[:10]
            hits += len({ids[t] for t in top} & set(got[name]))
            pairs += 10
            expected |= {tuple(sorted((name, ids[t]))) for t in top if cos[i, t] >= 0.9}
    assert hits / pairs >= 0.9
    assert {tuple(r) for r in neighbours.close_pairs(df).collect()} == expected
    assert neighbours.neighbours(df.limit(0)).count() == 0


def test_copies_and_ties(spark):
    rows = [(f"c{i:02}", [1.0, 2.0, 3.0], "m", 3, 0, 0) for i in range(30)]
    got = neighbours.neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 300 and all(abs(r.similarity - 1) < 1e-12 and r.chunk_id != r.neighbour_id for r in got)


def test_beam_beats_greedy_and_norms_are_stored():
    rng = np.random.default_rng(1)
    x = neighbours.unit(rng.normal(size=(2400, 24)))
    index, held_out = neighbours.Index.train(x[:2000], 4), x[2000:]
    codes, norms = index.encode(held_out)
    sums = sum(index.books[codes[:, b]] for b in range(neighbours.BOOKS))
    assert np.allclose((sums**2).sum(1), norms, atol=1e-4)
    greedy = np.zeros_like(held_out)
    for b in range(neighbours.BOOKS):
        book = index.books[b * index.words : (b + 1) * index.words]
        greedy = greedy + book[(((held_out - greedy)[:, None] - book[None]) ** 2).sum(2).argmin(1)]
    assert ((sums - held_out) ** 2).sum() < 0.9 * ((greedy - held_out) ** 2).sum()


def test_a_block_gives_its_true_best_in_a_hot_group():
    rng = np.random.default_rng(8)
    group = rng.normal(size=64) + rng.normal(size=(2000, 64)) * 0.02
    x = neighbours.unit(np.concatenate([group, rng.normal(size=(4000, 64))]).astype(np.float32))
    index = neighbours.Index.train(x, 6)
    for block in (x[:2000], x[1000:3000]):
        codes, norms = index.encode(block)
        own = np.arange(len(block))
        own[::7] = -1  # queries of another block
        cos = block @ block.T
        held = np.flatnonzero(own >= 0)
        cos[held, own[held]] = -np.inf
        best = -np.sort(-cos, axis=1)[:, :10]
        for least in (-2.0, 0.9):
            at, found = index.search(block, own, block, codes, norms, 10, least=least)
            assert (at[held] != own[held, None]).all()
            wanted = best >= least
            assert np.allclose(found[wanted], best[wanted], atol=1e-9) and (found[~wanted] < least).all()


def test_margins_reach_close_neighbours_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 40)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(2000, 32))
    x = np.concatenate([base, base[:700] + rng.normal(size=(700, 32)) * 0.3]).astype(np.float32)
    df = spark.createDataFrame([(f"v{i:04}", v.tolist(), "m", 32, 0, 0) for i, v in enumerate(x)], SCHEMA)
    u = neighbours.unit(x)
    cos = u @ u.T
    np.fill_diagonal(cos, -2)
    wanted = {tuple(sorted((f"v{i:04}", f"v{t:04}"))) for i in range(len(x)) for t in np.argsort(-cos[i])[:10] if cos[i, t] >= 0.9}
    got = {tuple(r) for r in neighbours.close_pairs(df).collect()}
    assert got <= wanted and len(got) >= 0.999 * len(wanted) and len(wanted) > 500
    index = neighbours.Index.train(u, 60)
    for cells, near in zip(index.cells_within(u, 0.1), index.nearest_cells(u, 60)):
        assert cells[0] == near[0] and len(set(cells)) == len(cells) < 60
    measured = neighbours.recall(df, many=64).collect()
    assert [(r.embedding_model, r.n_queries, r.n_true) for r in measured] == [("m", 64, 640)] and measured[0].recall >= 0.9
