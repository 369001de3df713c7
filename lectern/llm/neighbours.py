"""The k most similar vectors of every vector, by additive quantisation.

Vectors of one model and width form a collection. A bounded sample of it trains the index: cells (a spherical k-means whose
number of cells follows the collection's size) and ``BOOKS`` full-dimensional codebooks, each fitted to the residuals of the
sum so far. Every vector is then encoded by beam search, as the sum of one codeword per book, and its code and the norm of
that sum are stored. A query looks into its nearest cells: lookup tables of its products with all codewords score the
cell's codes (sum of table entries over the stored norm), the best are reranked with exact cosines. The preselection loses
nothing: a cosine is at most the sum of table entries plus the length of what the code leaves over, and where a vector that
wasn't reranked may by that bound still belong to the result, the query is compared with its whole block.

How many cells a query looks into is measured, not assumed: a bounded sample of queries is compared with every vector, and
the least number of cells that reaches ``AIM`` of their true neighbours is taken. Where only neighbours above a similarity are
asked for, a query looks into the cells whose border with its own is near: a neighbour at distance r lies beyond a border at
distance b only if their difference goes that way by b, and in d dimensions it goes r / sqrt(d) that way, give or take. The
margin is ``SPREAD`` times that, or what the sample's true neighbours need, whichever is more. As a block gives its true best,
the share of neighbours so reached is the recall of the whole search on the sample; :func:`recall` measures it on other
queries, over the whole path. A cell that holds very many vectors or queries is split into blocks of bounded size, every block
of its vectors meeting every block of its queries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.plans.lineage import cut

#: Bounds of the training sample: vectors, and values in all.
SAMPLE, SAMPLE_VALUES = 16_384, 16_777_216
#: Vectors of a cell aimed at, and most cells of a collection (their training needs a few vectors of the sample each).
CELL, MAX_CELLS = 1_024, 4_096
#: Codebooks, codewords of each, width of the beam, candidates of a block that are reranked.
BOOKS, WORDS, BEAM, RERANK = 8, 256, 4, 192
#: More than single precision can err by in a product of unit vectors or in the length of a difference.
ROUNDING = 1e-4
#: Vectors and queries of one block.
BLOCK, QUERIES = 2_048, 8_192
#: Queries of the recall measurement, those where only close neighbours count, and the share of true neighbours to reach.
PROBE_QUERIES, CLOSE_QUERIES, AIM = 256, 1_024, 0.98
#: Standard deviations of a near neighbour's offset across a border that a query looks beyond it.
SPREAD = 2.5
MAX_COLLECTIONS = 1_000
#: Neighbours and least similarity of p5_found (fixed by the problem).
K, SIMILARITY = 10, 0.9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; any finite length other than 0 is allowed."""
    wide = vectors.astype(np.float64)
    wide /= np.maximum(np.abs(wide).max(axis=1, keepdims=True), 5e-324)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, spherical: bool, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.concatenate([(part @ centres.T - (0 if spherical else (centres**2).sum(1) / 2)).argmax(1) for part in np.array_split(x, -(-len(x) // 4096))])
        order = np.argsort(near, kind="stable")
        counts = np.bincount(near, minlength=k)
        held = counts > 0
        sums = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(counts[held])[:-1]]), axis=0)
        centres[held] = sums / counts[held][:, None]
        if (~held).any():
            centres[~held] = x[rng.choice(len(x), int((~held).sum()))]
        if spherical:
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass
class Index:
    """Cells and codebooks of one collection."""

    cells: np.ndarray  # (cells, d)
    books: np.ndarray  # (BOOKS * words, d)
    words: int
    products: np.ndarray  # of every two codewords

    @classmethod
    def train(cls, sample: np.ndarray, n_cells: int, seed: int = 7) -> Index:
        rng = np.random.default_rng(seed)
        x = sample.astype(np.float32)
        cells = _kmeans(x, max(1, min(n_cells, len(x))), rng, True)
        words = min(WORDS, max(1, len(x) // 2))
        books, residual = [], x.copy()
        for _ in range(BOOKS):
            book = _kmeans(residual, words, rng, False)
            near = np.concatenate([(part @ book.T - (book**2).sum(1) / 2).argmax(1) for part in np.array_split(residual, -(-len(residual) // 4096))])
            residual = residual - book[near]
            books.append(book)
        whole = np.concatenate(books).astype(np.float32)
        return cls(cells.astype(np.float32), whole, words, whole @ whole.T)

    def nearest_cells(self, x: np.ndarray, many: int) -> np.ndarray:
        """(n, many) cells of each vector, nearest first."""
        near = x.astype(np.float32) @ self.cells.T
        many = min(many, near.shape[1])
        if many < near.shape[1]:
            part = np.argpartition(-near, many - 1, axis=1)[:, :many]
        else:
            part = np.broadcast_to(np.arange(many), near.shape)
        return np.take_along_axis(part, np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable"), 1)

    def cells_within(self, x: np.ndarray, margin: float) -> list[np.ndarray]:
        """Of each vector its own cell, then the others whose border with it is at most ``margin`` away, nearest first."""
        out = []
        for part in np.array_split(x.astype(np.float32), max(1, -(-len(x) // 4096))):
            near = part @ self.cells.T
            own = near.argmax(1)
            apart = np.sqrt(np.maximum(0, 2 - 2 * (self.cells[own] @ self.cells.T)))
            behind = near[np.arange(len(part)), own][:, None] - near
            rows, cells = np.nonzero(behind <= margin * apart + 1e-6)
            order = np.lexsort((behind[rows, cells], cells != own[rows], rows))
            out += np.split(cells[order], np.cumsum(np.bincount(rows, minlength=len(part)))[:-1])
        return out

    def borders(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How far each vector's border with a cell is: 0 for its own."""
        near = q.astype(np.float32) @ self.cells.T
        own = near.argmax(1)
        at = np.arange(len(q))
        apart = np.sqrt(np.maximum(0, 2 - 2 * (self.cells[own] * self.cells[cells]).sum(1)))
        return np.where(cells == own, 0, (near[at, own] - near[at, cells]) / np.maximum(apart, 1e-9))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes (n, BOOKS), squared norms of the sums): for each vector the best of ``BEAM`` sums of codewords, book by book."""
        codes, norms = [], []
        for part in np.array_split(x.astype(np.float32), max(1, -(-len(x) // 1024))):
            n = len(part)
            dots = part @ self.books.T
            kept = np.zeros((n, 1, 0), np.int64)  # codewords of each partial sum
            cost = np.zeros((n, 1), np.float32)  # |sum|^2 - 2 <x, sum>
            for book in range(BOOKS):
                base = book * self.words
                own = slice(base, base + self.words)
                add = np.diag(self.products)[own][None, None, :] - 2 * dots[:, None, own]
                grown = cost[:, :, None] + add
                for before in range(book):
                    grown = grown + 2 * self.products[:, own][kept[:, :, before]]
                flat = grown.reshape(n, -1)
                beam = min(BEAM, flat.shape[1])
                best = np.argpartition(flat, beam - 1, axis=1)[:, :beam] if beam < flat.shape[1] else np.broadcast_to(np.arange(beam), (n, beam))
                cost = np.take_along_axis(flat, best, 1)
                source, word = best // self.words, best % self.words + base
                kept = np.concatenate([np.take_along_axis(kept, source[:, :, None], 1), word[:, :, None]], axis=2)
            winner = cost.argmin(1)
            rows = np.arange(n)
            codes.append(kept[rows, winner])
            norms.append(cost[rows, winner] + 2 * np.take_along_axis(dots, kept[rows, winner], 1).sum(1))
        return np.concatenate(codes).astype(np.uint16), np.concatenate(norms).astype(np.float32)

    def search(self, queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, codes: np.ndarray, norms: np.ndarray, k: int, rerank: int = RERANK, least: float = -2.0) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines), each (queries, up to k), of the best vectors of a block; -1 where there are fewer.

        ``own`` is the position of the query itself among the vectors, or -1. Scores come from the lookup tables, the
        best ``rerank`` are compared exactly. By Cauchy and Schwarz <q, x> <= <q, sum> + |x - sum|: a query for which that
        bound doesn't part the rest from its k-th best so far (or from ``least``) is compared with the whole block.
        """
        out_at, out_cos = [], []
        single, scale = vectors.astype(np.float32), 1 / np.sqrt(np.maximum(norms, 1e-12))
        words = codes.T.astype(np.int64)
        many = max(rerank, 3 * k)
        if many < len(vectors):
            rest = single.copy()
            for book in words:
                rest -= self.books[book]
            rest = np.linalg.norm(rest, axis=1) + ROUNDING
        for low in range(0, len(queries), 512):
            q, mine = queries[low : low + 512], own[low : low + 512]
            tables = np.ascontiguousarray(self.books @ q.astype(np.float32).T)  # (codewords, queries): rows are gathered
            sums = tables[words[0]]
            for book in words[1:]:
                sums += tables[book]
            scores = np.ascontiguousarray((sums * scale[:, None]).T)
            scores[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
            best = _top(scores, many)
            near = np.matmul(single[best], q.astype(np.float32)[:, :, None])[:, :, 0]
            near[best == mine[:, None]] = -np.inf
            if many < len(vectors):
                floor = np.maximum(-np.partition(-near, k - 1, axis=1)[:, k - 1], least) - ROUNDING
                bound = np.ascontiguousarray((sums + rest[:, None]).T)
                np.put_along_axis(bound, best, -np.inf, 1)
                bound[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
                unsure = np.flatnonzero(bound.max(axis=1) >= floor)
            best = np.take_along_axis(best, _top(near, 3 * k), 1)
            if many < len(vectors) and len(unsure):
                whole = q[unsure].astype(np.float32) @ single.T
                held = mine[unsure] >= 0
                whole[np.flatnonzero(held), mine[unsure][held]] = -np.inf
                best[unsure] = _top(whole, 3 * k)
            cos = np.matmul(vectors[best], q[:, :, None])[:, :, 0]  # the last word is in double precision
            cos[best == mine[:, None]] = -np.inf
            order = np.argsort(-cos, axis=1, kind="stable")[:, :k]
            at, cos = np.take_along_axis(best, order, 1), np.take_along_axis(cos, order, 1)
            at[~np.isfinite(cos)] = -1
            out_at.append(at)
            out_cos.append(cos)
        return np.concatenate(out_at), np.concatenate(out_cos)


def _top(scores: np.ndarray, many: int) -> np.ndarray:
    """The positions of the ``many`` greatest of each row, in no order."""
    if many >= scores.shape[1]:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape).copy()
    return np.argpartition(-scores, many - 1, axis=1)[:, :many]


# ---- Spark ----


def valid_vectors(embedded: DataFrame) -> DataFrame:
    """(chunk_id, model, width, vector): the valid vectors as 32-bit floats in bytes, repeated deliveries once.

    Valid: a key and a model, exactly ``dimensions`` values, all finite (nulls among them count as not finite), not all zero.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            offsets = lists.offsets.to_numpy()
            values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            widths = np.diff(offsets)
            wanted = batch.column("dimensions").to_numpy(zero_copy_only=False)
            finite = np.isfinite(values.astype(np.float32))
            bad = np.concatenate([[0], np.cumsum(~finite)])
            some = np.concatenate([[0], np.cumsum(np.nan_to_num(values, nan=0.0) != 0)])
            ok = (widths == wanted) & (widths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]]) & (some[offsets[1:]] > some[offsets[:-1]])
            rows = np.flatnonzero(ok)
            single = values.astype(np.float32)
            vectors = [single[offsets[i] : offsets[i + 1]].tobytes() for i in rows]
            yield pa.RecordBatch.from_arrays([batch.column("chunk_id").take(pa.array(rows)), batch.column("embedding_model").take(pa.array(rows)), pa.array(widths[rows], pa.int32()), pa.array(vectors, pa.binary())], names=["chunk_id", "model", "width", "vector"])

    own = embedded.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.col("embedding_model").cast("string").alias("embedding_model"), F.col("dimensions").cast("int").alias("dimensions"), F.col("embedding").cast("array<float>").alias("embedding"))
    own = own.where(F.col("chunk_id").isNotNull() & F.col("embedding_model").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") == F.col("dimensions")))
    return own.mapInArrow(run, "chunk_id string, model string, width int, vector binary").dropDuplicates(["chunk_id", "model", "width"])


def _by_collection(batch: pa.RecordBatch, number: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(collection, rows, unit vectors) of a batch with the columns model, width and vector."""
    keys = [number[key] for key in zip(batch.column("model").to_pylist(), batch.column("width").to_pylist())]
    keys = np.array(keys, np.int64)
    for no in np.unique(keys):
        rows = np.flatnonzero(keys == no)
        taken = batch.column("vector").take(pa.array(rows))
        yield int(no), rows, unit(np.frombuffer(b"".join(taken.to_pylist()), np.float32).reshape(len(rows), -1))


class Collections:
    """The collections of a table of valid vectors, their indexes and the number of cells a query looks into."""

    def __init__(self, vectors: DataFrame, k: int, least: float = -2.0, aim: float = AIM):
        spark = vectors.sparkSession
        counted = vectors.groupBy("model", "width").agg(F.count("*").alias("n")).orderBy("model", "width").limit(MAX_COLLECTIONS + 1).collect()
        if len(counted) > MAX_COLLECTIONS:
            raise ValueError(f"more than {MAX_COLLECTIONS} models")
        self.number = {(r["model"], r["width"]): no for no, r in enumerate(counted)}
        self.indexes, queries = [], {}
        for no, row in enumerate(counted):
            many = max(256, min(SAMPLE, SAMPLE_VALUES // row["width"]))
            own = vectors.where((F.col("model") == row["model"]) & (F.col("width") == row["width"])).select("chunk_id", "vector", F.xxhash64("chunk_id").alias("h"))
            if row["n"] > 4 * many:  # so that only about twice the sample is sorted
                own = own.where(F.pmod("h", F.lit(1 << 40)) < int((1 << 40) * 2 * many / row["n"]))
            drawn = own.orderBy("h", "chunk_id").limit(many).collect()
            sample = unit(np.frombuffer(b"".join(bytes(r["vector"]) for r in drawn), np.float32).reshape(len(drawn), row["width"]))
            self.indexes.append(Index.train(sample, min(MAX_CELLS, round(row["n"] / CELL))))
            probe = PROBE_QUERIES if least < -1 else CLOSE_QUERIES
            queries[no] = ([r["chunk_id"] for r in drawn[:probe]], sample[:probe])
        self.shared = spark.sparkContext.broadcast((self.number, self.indexes))
        top = true_neighbours(vectors, self.shared, queries, k, least).select("no", "query", "cell").collect()
        #: Of each collection the number of cells to look into, or the margin, and the recall reached on the sample.
        self.looks, self.measured = [], []
        for no, (_, q) in sorted(queries.items()):
            met = np.array([(r["query"], r["cell"]) for r in top if r["no"] == no], np.int64).reshape(-1, 2)
            look, reached = self._look(self.indexes[no], q, met[:, 0], met[:, 1], least, aim)
            self.looks.append(look)
            self.measured.append(reached)

    def _look(self, index: Index, q: np.ndarray, query: np.ndarray, cell: np.ndarray, least: float, aim: float) -> tuple[int | float, float]:
        """The number of cells, or where only close neighbours are asked for the margin, and the share of the true neighbours
        (their queries and cells are given) that it reaches."""
        if least < -1:
            rank = np.argsort(index.nearest_cells(q, len(index.cells)), axis=1)[query, cell]
            at = np.sort(rank)
            need = int(at[min(len(at) - 1, int(np.ceil(aim * len(at))) - 1)]) + 1 if len(at) else 1
            need = min(len(index.cells), max(need, 2))
            return need, float((at < need).mean()) if len(at) else 1.0
        margin = SPREAD * float(np.sqrt((2 - 2 * least) / q.shape[1]))
        away = index.borders(q[query], cell) if len(query) else np.zeros(0)
        margin = max(margin, 1.25 * float(away.max(initial=0)))
        return margin, float((away <= margin).mean()) if len(away) else 1.0


def true_neighbours(vectors: DataFrame, shared, queries: dict, k: int, least: float = -2.0) -> DataFrame:
    """(no, query, cos, id, cell, rank): the k nearest of every vector, of at least ``least``, for a bounded set of queries
    {collection: (ids, unit vectors)}, each compared with all vectors of its collection; ``cell`` is the neighbour's."""
    sent = vectors.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, indexes = shared.value
        best: dict[tuple[int, int], list] = {}
        for batch in batches:
            ids = batch.column("chunk_id").to_pylist()
            for no, rows, x in _by_collection(batch, number):
                names, q = sent.value[no]
                cell = indexes[no].nearest_cells(x, 1)[:, 0]
                cos = q @ x.T
                for at in np.flatnonzero(cos.max(axis=1) >= least):
                    top = np.argpartition(-cos[at], min(k, len(rows) - 1))[: k + 1]
                    held = best.setdefault((no, int(at)), [])
                    held += [(float(cos[at, i]), ids[rows[i]], int(cell[i])) for i in top if cos[at, i] >= least and ids[rows[i]] != names[at]]
                    held.sort(reverse=True)
                    del held[k:]
        out = [(no, at, c, i, cell) for (no, at), held in best.items() for c, i, cell in held]
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.int32()))], names=["no", "query", "cos", "id", "cell"])

    found = vectors.mapInArrow(run, "no int, query int, cos double, id string, cell int")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("no", "query").orderBy(F.desc("cos"), "id"))).where(F.col("rank") <= k)


def assigned(vectors: DataFrame, collections: Collections) -> DataFrame:
    """(chunk_id, no, vector, code, norm, cells): every vector with its code and the cells it looks into, its own first."""
    shared, looks = collections.shared, list(collections.looks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, indexes = shared.value
        for batch in batches:
            for no, rows, x in _by_collection(batch, number):
                codes, norms = indexes[no].encode(x)
                cells = list(indexes[no].nearest_cells(x, looks[no])) if isinstance(looks[no], int) else indexes[no].cells_within(x, looks[no])
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column("chunk_id").take(at), pa.array(np.full(len(rows), no, np.int32)), batch.column("vector").take(at), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms), pa.array([c.tolist() for c in cells], pa.list_(pa.int32()))], names=["chunk_id", "no", "vector", "code", "norm", "cells"])

    return vectors.mapInArrow(run, "chunk_id string, no int, vector binary, code binary, norm float, cells array<int>")


def _blocks(placed: DataFrame) -> DataFrame:
    """Vectors (side 0) and queries (side 1) sent to the blocks where they meet: (block, side, chunk_id, no, vector, code, norm)."""
    looks = placed.select("no", F.posexplode("cells").alias("rank", "cell"))
    parts = looks.groupBy("no", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count_if(F.col("rank") == 0) / BLOCK)).cast("int").alias("v"), F.greatest(F.lit(1), F.ceil(F.count("*") / QUERIES)).cast("int").alias("q"))
    salt = F.xxhash64("chunk_id")
    stored = placed.withColumn("cell", F.col("cells")[0]).join(parts, ["no", "cell"]).withColumn("vp", F.pmod(salt, F.col("v")).cast("int")).withColumn("qp", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    asking = placed.withColumn("cell", F.explode("cells")).join(parts, ["no", "cell"]).withColumn("qp", F.pmod(salt, F.col("q")).cast("int")).withColumn("vp", F.explode(F.sequence(F.lit(0), F.col("v") - 1)))
    block = F.xxhash64("no", "cell", "vp", "qp").alias("block")
    a = stored.select(block, F.lit(0).alias("side"), "chunk_id", "no", "vector", "code", "norm")
    b = asking.select(block, F.lit(1).alias("side"), "chunk_id", "no", "vector", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("float").alias("norm"))
    return a.unionByName(b)


def neighbours(embedded: DataFrame, k: int = K, least: float = -2.0) -> DataFrame:
    """(chunk_id, neighbour_id, similarity, rank): of every valid vector its k most similar of the same model and width,
    those of at least ``least``; ties go to the smaller id. Invalid vectors have no rows."""
    vectors = cut(valid_vectors(embedded))
    return _ranked(vectors, Collections(vectors, k, least), k, least).drop("no")


def _ranked(vectors: DataFrame, collections: Collections, k: int, least: float) -> DataFrame:
    """(no, chunk_id, neighbour_id, similarity, rank)."""
    shared = collections.shared
    placed = cut(assigned(vectors, collections))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, indexes = shared.value
        held = None  # the vectors of the current block
        names = ["no", "chunk_id", "neighbour_id", "similarity"]
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            sides = batch.column("side").to_numpy()
            cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (sides[1:] != sides[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(blocks)]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                no = part.column("no")[0].as_py()
                x = unit(np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float32).reshape(len(part), -1))
                ids = part.column("chunk_id").to_pylist()
                if sides[low] == 0:
                    codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint16).reshape(len(part), BOOKS)
                    norms = part.column("norm").to_numpy()
                    if held and held[0] == blocks[low]:
                        held = (blocks[low], held[1] + ids, np.concatenate([held[2], x]), np.concatenate([held[3], codes]), np.concatenate([held[4], norms]))
                    else:
                        held = (blocks[low], ids, x, codes, norms)
                    continue
                if not held or held[0] != blocks[low]:
                    continue
                where = {name: at for at, name in enumerate(held[1])}
                own = np.array([where.get(name, -1) for name in ids])
                at, cos = indexes[no].search(x, own, held[2], held[3], held[4], k, least=least)
                rows, columns = np.nonzero((at >= 0) & (cos >= least))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), no, np.int32)), pa.array([ids[i] for i in rows], pa.string()), pa.array([held[1][i] for i in at[rows, columns]], pa.string()), pa.array(cos[rows, columns])], names=names)

    spark = vectors.sparkSession
    sent = _blocks(placed).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block", "side")
    found = sent.mapInArrow(run, "no int, chunk_id string, neighbour_id string, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("no", "chunk_id").orderBy(F.desc("similarity"), "neighbour_id")))
    return ranked.where(F.col("rank") <= k)


def close_pairs(embedded: DataFrame, k: int = K, least: float = SIMILARITY) -> DataFrame:
    """(chunk_id_a, chunk_id_b), the smaller id first: pairs at least ``least`` similar, one among the k nearest of the other.

    Neighbours below ``least`` can't push one above it out of the k nearest, so blocks send on only those above.
    """
    near = neighbours(embedded, k, least)
    return near.select(F.least("chunk_id", "neighbour_id").alias("chunk_id_a"), F.greatest("chunk_id", "neighbour_id").alias("chunk_id_b")).distinct()


def recall(embedded: DataFrame, k: int = K, many: int = PROBE_QUERIES) -> DataFrame:
    """(embedding_model, width, n_queries, n_true, n_found, recall) over the whole path: of each collection ``many`` queries,
    drawn by another hash than the training sample, are compared with every vector, and their true neighbours are looked up
    among the rows that :func:`neighbours` gives. A neighbour as similar as the true k-th counts as found."""
    vectors = cut(valid_vectors(embedded))
    collections = Collections(vectors, k)
    drawn = {}
    for (model, width), no in collections.number.items():
        own = vectors.where((F.col("model") == model) & (F.col("width") == width)).select("chunk_id", "vector").orderBy(F.xxhash64("chunk_id", F.lit("held out")), "chunk_id").limit(many).collect()
        drawn[no] = ([r["chunk_id"] for r in own], unit(np.frombuffer(b"".join(bytes(r["vector"]) for r in own), np.float32).reshape(len(own), width)))
    spark = vectors.sparkSession
    names = spark.createDataFrame([(no, at, name) for no, (ids, _) in drawn.items() for at, name in enumerate(ids)], "no int, query int, chunk_id string")
    true = true_neighbours(vectors, collections.shared, drawn, k).groupBy("no", "query").agg(F.count("*").alias("n_true"), F.min("cos").alias("least"))
    asked = names.join(true, ["no", "query"])
    found = _ranked(vectors, collections, k, -2.0).join(F.broadcast(asked), ["no", "chunk_id"]).where(F.col("similarity") >= F.col("least") - 1e-9)
    counted = found.groupBy("no").agg(F.count("*").alias("n_found"))
    totals = asked.groupBy("no").agg(F.count("*").alias("n_queries"), F.sum("n_true").alias("n_true"))
    keys = spark.createDataFrame([(model, width, no) for (model, width), no in collections.number.items()], "embedding_model string, width int, no int")
    return keys.join(totals, "no").join(counted, "no", "left").select("embedding_model", "width", "n_queries", "n_true", F.coalesce("n_found", F.lit(0)).alias("n_found"), (F.coalesce("n_found", F.lit(0)) / F.col("n_true")).alias("recall"))
