"""Groups of near-duplicate texts by bit-sliced comparison of sketches.

A text is the set of its runs of three words, as 64-bit hashes; texts with equal sets are one class from the start, so
copies are never compared. Candidates come from an exact prefix filter: with the elements of every set in one global
order, two sets of Jaccard similarity t share an element among their first n - ceil(t * n) + 1. The order is by frequency
in the whole corpus, rarest first, as counted in a table of fixed size (frequencies that collide only make the order less
sharp, never inexact). Texts that share a prefix element form a block.

Blocks are compared bit-sliced. Each set has a sketch of ``PLANES`` bits (the parities of as many minimum hashes, so that
the share of differing bits estimates half the Jaccard distance). The sketches of 64 texts are stored vertically, one
64-bit word per bit plane; a text is compared with all 64 at once: planes are XORed in order and summed by carry-save
adders into vertical counters, and a block is abandoned as soon as all its lanes exceed the radius. The radius lies seven
standard deviations beyond the mean of a pair just similar enough. Pairs that stay are verified exactly on their sets.

A prefix element that very many different texts share is salted: its texts are counted exactly and split into parts, and
every pair of parts becomes a block of its own, so nothing is capped and no task gets an unbounded block. Hub nodes of the
components and classes of very many copies are left to salts of their own and to the adaptive skew join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.lineage import broadcast_checked, cut

#: Words of a shingle and the least similarity of p4_found (fixed by the problem); the general default is five words, 0.8.
WORDS, SIMILARITY = 3, 0.7
PLANES = 128
#: Buckets of the frequency table: 8 MB in all, whatever the size of the corpus.
BUCKETS, SLICES = 1 << 20, 256
#: Texts that a prefix element may have in one block before it is salted, and copies of a text that meet in one.
BLOCK_TEXTS, BLOCK_COPIES = 4096, 2048
#: The label before the text in embedding_text.
_LABEL = re.compile(r"(?:^|\n)Content: ")
_WORD = re.compile(r"[^\W_]+")
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class _Hashes(dict):
    """Words to 64-bit hashes; kept to a bounded size."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


def body_of(content: str | None, embedding: str | None) -> str | None:
    """content_text, or where it is null the part of embedding_text after its label; None where there is neither."""
    if content is not None:
        return content
    met = _LABEL.search(embedding) if embedding is not None else None
    return embedding[met.end() :] if met else None


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _K3
    h ^= h >> np.uint64(29)
    return h


def shingle_sets(bodies: list[str | None], hashes: _Hashes, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(elements, offsets): the distinct shingle hashes of each body, ascending, body i at elements[offsets[i]:offsets[i+1]]."""
    counts, flat = np.zeros(len(bodies), np.int64), []
    for at, body in enumerate(bodies):
        if body:
            own = _WORD.findall(body.lower())
            if len(own) >= words:
                counts[at] = len(own)
                flat += own
    ids = np.fromiter(map(hashes.__getitem__, flat), np.uint64, len(flat))
    total = len(ids)
    if total < words:
        return np.zeros(0, np.uint64), np.zeros(len(bodies) + 1, np.int64)
    h = ids[: total - words + 1] * _K1
    for step in range(1, words):
        h ^= h >> np.uint64(32)
        h *= _K2
        h += ids[step : total - words + 1 + step]
    h = _mixed(h)
    doc = np.repeat(np.arange(len(bodies)), counts)
    ends = np.cumsum(counts)[doc]
    keep = np.arange(len(h)) + words <= ends[: len(h)]
    h, doc = h[keep], doc[: len(keep)][keep]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[first], doc[first]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(bodies)))]).astype(np.int64)


def _signatures(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit signature of each set; equal sets have equal ones."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(elements * _K1), dtype=np.uint64)])
    sizes = np.diff(offsets).astype(np.uint64)
    return _mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * _K2 + sizes * _K1)


_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, PLANES, dtype=np.uint64) | np.uint64(1)


def sketches(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, PLANES / 64) words of min-hash parities; every set must have an element."""
    out = np.zeros((len(offsets) - 1, PLANES // 64), np.uint64)
    starts = offsets[:-1]
    for plane, seed in enumerate(_SEEDS):
        least = np.minimum.reduceat(_mixed(elements * seed), starts)
        out[:, plane // 64] |= ((least * _K1) >> np.uint64(63)) << np.uint64(plane % 64)
    return out


def prefix_length(n: np.ndarray, similarity: float) -> np.ndarray:
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1


def radius(similarity: float) -> int:
    """The most differing bits of a pair at least this similar, seven standard deviations beyond the mean."""
    p = (1 - similarity) / 2
    return min(PLANES, math.ceil(PLANES * p + 7 * math.sqrt(PLANES * p * (1 - p))))


# ---- bit-sliced comparison ----


def _add3(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: (ones, twos) of three words, lane by lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _within(counters: list[np.ndarray], most: int) -> np.ndarray:
    """The lanes whose vertical counter is at most ``most``."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for bit in range(len(counters) - 1, -1, -1):
        plane = counters[bit]
        if most >> bit & 1:
            equal = equal & plane
        else:
            above |= equal & plane
            equal = equal & ~plane
    return ~above


def bit_sliced_matches(planes: np.ndarray, queries: np.ndarray, blocks: np.ndarray, sketch: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Compares texts with blocks of 64: (positions of the pairs (queries[i], blocks[i]) that have a lane left, those lanes).

    planes: (PLANES, blocks) vertical words; sketch: (texts, PLANES / 64). Eight planes at a time go through carry-save
    adders into the ones, twos, fours and, rippling, the higher counters; pairs without a lane within the radius are
    dropped after every 32 planes.
    """
    alive = np.arange(len(queries))
    lanes = np.full(len(queries), ~np.uint64(0))
    zero = np.zeros(len(queries), np.uint64)
    counters = [zero.copy() for _ in range(PLANES.bit_length())]
    for start in range(0, PLANES, 8):
        q, b = queries[alive], blocks[alive]
        word = sketch[q, start // 64]
        d = [planes[p, b] ^ (np.uint64(0) - ((word >> np.uint64(p % 64)) & np.uint64(1))) for p in range(start, start + 8)]
        ones, a = _add3(counters[0], d[0], d[1])
        ones, c = _add3(ones, d[2], d[3])
        twos, fours_a = _add3(counters[1], a, c)
        ones, a = _add3(ones, d[4], d[5])
        ones, c = _add3(ones, d[6], d[7])
        twos, fours_b = _add3(twos, a, c)
        fours, carry = _add3(counters[2], fours_a, fours_b)
        counters[:3] = [ones, twos, fours]
        for bit in range(3, len(counters)):
            counters[bit], carry = counters[bit] ^ carry, counters[bit] & carry
        if (start + 8) % 32 == 0:
            lanes = _within(counters, most)
            left = lanes != 0
            if not left.all():
                alive, lanes, counters = alive[left], lanes[left], [x[left] for x in counters]
            if not len(alive):
                break
    return alive, lanes


def _transpose(sketch: np.ndarray, block: np.ndarray, lane: np.ndarray, n_blocks: int) -> np.ndarray:
    """Bit planes (PLANES, n_blocks) of texts that lie in lane ``lane`` of block ``block``; blocks ascend."""
    starts = np.searchsorted(block, np.arange(n_blocks))
    lane = lane.astype(np.uint64)
    out = np.empty((PLANES, n_blocks), np.uint64)
    for plane in range(PLANES):
        out[plane] = np.bitwise_or.reduceat(((sketch[:, plane // 64] >> np.uint64(plane % 64)) & np.uint64(1)) << lane, starts)
    return out


def block_pairs(key: np.ndarray, ids: np.ndarray, size: np.ndarray, sketch: np.ndarray, similarity: float, most: int) -> np.ndarray:
    """(pairs, 2) of ids, smaller first, of texts with one key whose sizes and sketches allow the similarity.

    Rows with one key must stand together; an id that comes twice under a key counts once.
    """
    order = np.lexsort((ids, size, key))
    key, ids, size, sketch = key[order], ids[order], size[order], sketch[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
    key, ids, size, sketch = key[new], ids[new], size[new], sketch[new]
    _, first, run, many = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    keep = many[run] > 1
    if not keep.any():
        return np.zeros((0, 2), ids.dtype)
    key, ids, size, sketch = key[keep], ids[keep], size[keep], sketch[keep]
    _, first, run, many = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    place = np.arange(len(key)) - first[run]
    blocks_of = -(-many // 64)
    base = np.concatenate([[0], np.cumsum(blocks_of)])[:-1]
    block, lane = base[run] + place // 64, place % 64
    n_blocks = int(blocks_of.sum())
    planes = _transpose(sketch, block, lane, n_blocks)
    largest = np.maximum.reduceat(size, np.searchsorted(block, np.arange(n_blocks)))
    found = []
    # A text looks at its own block and the earlier ones of its run, as long as sizes allow: they ascend within a run.
    back = 0
    at = np.arange(len(key))
    while len(at):
        other = block[at] - back
        ok = other >= base[run[at]]
        at, other = at[ok], other[ok]
        ok = largest[other] >= similarity * size[at] - 1e-9
        at, other = at[ok], other[ok]
        for low in range(0, len(at), 1 << 15):
            q, b = at[low : low + (1 << 15)], other[low : low + (1 << 15)]
            alive, lanes = bit_sliced_matches(planes, q, b, sketch, most)
            while len(alive):
                low_bit = lanes & (~lanes + np.uint64(1))
                where = np.log2(low_bit.astype(np.float64)).astype(np.int64)
                mine = q[alive]
                position = (b[alive] - base[run[mine]]) * 64 + where
                real = position < place[mine]
                partner = first[run[mine[real]]] + position[real]
                mine = mine[real]
                fits = size[partner] >= similarity * size[mine] - 1e-9
                found.append(np.stack([ids[mine[fits]], ids[partner[fits]]], 1))
                lanes ^= low_bit
                left = lanes != 0
                alive, lanes = alive[left], lanes[left]
        back += 1
    if not found:
        return np.zeros((0, 2), ids.dtype)
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


# ---- Spark ----


def _texts(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.col("content_text").cast("string").alias("content"), F.when(F.col("content_text").isNull(), F.col("embedding_text").cast("string")).alias("embedding")).where(F.col("chunk_id").isNotNull() & (F.col("content").isNotNull() | F.col("embedding").isNotNull()))


def _bodies(batch: pa.RecordBatch) -> list[str | None]:
    return [body_of(c, e) for c, e in zip(batch.column("content").to_pylist(), batch.column("embedding").to_pylist())]


def frequencies(texts: DataFrame, words: int = WORDS) -> np.ndarray:
    """How many texts hold an element of each bucket, over the whole corpus: a table of fixed size, summed in slices."""
    width = BUCKETS // SLICES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hashes = np.zeros(BUCKETS, np.uint32), _Hashes()
        for batch in batches:
            elements, _ = shingle_sets(_bodies(batch), hashes, words)
            total += np.bincount((elements & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([total[i * width : (i + 1) * width].tobytes() for i in range(SLICES)], pa.binary())], names=["slice", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for no, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(counts.as_buffer(), np.uint32).astype(np.uint64)
                sums[no] = sums[no] + own if no in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    parts = min(SLICES, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = texts.mapInArrow(count, schema).repartition(parts, "slice").mapInArrow(add, schema).collect()
    total = np.zeros(BUCKETS, np.uint64)
    for row in rows:
        total[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(bytes(row["counts"]), np.uint64)
    return total


def signatures(texts: DataFrame, counts: np.ndarray, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One row per text with at least one shingle: (chunk_id, sig, size, s0, s1, prefix, often). The sketch and prefix stand only
    with the first text of a class in each partition; ``often`` are the prefix elements that very many texts may share, as
    their bucket holds that many."""
    sent, most = texts.sparkSession.sparkContext.broadcast(counts), BLOCK_TEXTS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes, seen = sent.value, _Hashes(), set()
        for batch in batches:
            elements, offsets = shingle_sets(_bodies(batch), hashes, words)
            sizes = np.diff(offsets)
            sig = _signatures(elements, offsets)
            keep = sizes > 0
            fresh = np.zeros(len(sizes), bool)
            for at in np.flatnonzero(keep):
                own = int(sig[at])
                if own not in seen:
                    if len(seen) < 2_000_000:
                        seen.add(own)
                    fresh[at] = True
            chosen = np.flatnonzero(fresh)
            prefixes: list = [None] * len(sizes)
            crowded: list = [None] * len(sizes)
            sketch = np.zeros((len(sizes), PLANES // 64), np.uint64)
            if len(chosen):
                part = np.concatenate([elements[offsets[i] : offsets[i + 1]] for i in chosen])
                own_offsets = np.concatenate([[0], np.cumsum(sizes[chosen])]).astype(np.int64)
                sketch[chosen] = sketches(part, own_offsets)
                often = table[(part & np.uint64(BUCKETS - 1)).astype(np.int64)]
                doc = np.repeat(np.arange(len(chosen)), sizes[chosen])
                order = np.lexsort((part, often, doc))
                rank = np.arange(len(part)) - own_offsets[doc]
                first = order[rank < prefix_length(sizes[chosen], similarity)[doc]]
                cuts = np.cumsum(prefix_length(sizes[chosen], similarity))[:-1]
                for at, own in zip(chosen, np.split(first, cuts)):
                    prefixes[at] = part[own].view(np.int64)
                    crowd = often[own] > most
                    if crowd.any():
                        crowded[at] = part[own[crowd]].view(np.int64)
            where = pa.array(np.flatnonzero(keep))
            columns = [batch.column("chunk_id"), pa.array(sig.view(np.int64)), pa.array(sizes.astype(np.int32)), pa.array(sketch[:, 0].view(np.int64)), pa.array(sketch[:, 1].view(np.int64)), pa.array(prefixes, pa.list_(pa.int64())), pa.array(crowded, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([c.take(where) for c in columns], names=["chunk_id", "sig", "size", "s0", "s1", "prefix", "often"])

    return texts.mapInArrow(run, "chunk_id string, sig bigint, size int, s0 bigint, s1 bigint, prefix array<bigint>, often array<bigint>")


def blocks_of(signed: DataFrame) -> DataFrame:
    """(key, sig, size, s0, s1): every class in the blocks of its prefix elements. An element of more than ``BLOCK_TEXTS``
    texts is split: each text goes to the blocks of its own part paired with every part."""
    postings = signed.where(F.col("prefix").isNotNull()).select(F.explode("prefix").alias("key"), "sig", "size", "s0", "s1")
    heavy = cut(signed.where(F.col("often").isNotNull()).select(F.explode("often").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_TEXTS).select("key", F.ceil(F.col("n") / BLOCK_TEXTS).cast("int").alias("parts")))
    if heavy.isEmpty():
        return postings
    met = postings.join(broadcast_checked(heavy), "key", "left")
    own = F.pmod("sig", F.col("parts")).cast("int")
    spread = met.withColumn("own", own).withColumn("other", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
    block = F.when(F.col("parts").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    return spread.select(block.alias("key"), "sig", "size", "s0", "s1")


def candidates(signed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of classes (sig_a, sig_b) whose sketches lie within the radius, from blocks that share a prefix element."""
    most = radius(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            columns = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            held.append(columns)
            rows += len(columns[0])
            if rows < 50_000:
                continue
            # Keys come sorted: all but the last key are complete.
            joined = tuple(np.concatenate(c) for c in zip(*held))
            end = int(np.searchsorted(joined[0], joined[0][-1]))
            if not end:
                held = [joined]
                continue
            yield emit(tuple(c[:end] for c in joined))
            held, rows = [tuple(c[end:] for c in joined)], len(joined[0]) - end
        if held:
            yield emit(tuple(np.concatenate(c) for c in zip(*held)))

    def emit(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, sig, size, s0, s1 = columns
        pairs = block_pairs(key, sig, size, np.stack([s0, s1], 1).view(np.uint64), similarity, most)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["sig_a", "sig_b"])

    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks_of(signed).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "sig_a bigint, sig_b bigint").distinct()


def class_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(sig, elements): the shingle set of each class, once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _Hashes(), set()
        for batch in batches:
            elements, offsets = shingle_sets(_bodies(batch), hashes, words)
            sig = _signatures(elements, offsets)
            keys, sets = [], []
            for at in np.flatnonzero(np.diff(offsets)):
                own = int(sig[at])
                if own not in seen:
                    if len(seen) < 2_000_000:
                        seen.add(own)
                    keys.append(at)
                    sets.append(elements[offsets[at] : offsets[at + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sig[keys].view(np.int64)), pa.array(sets, pa.binary())], names=["sig", "elements"])

    return texts.mapInArrow(run, "sig bigint, elements binary").dropDuplicates(["sig"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The candidate pairs whose sets are similar enough, with their exact similarity: (sig_a, sig_b, similarity)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, out = [], [], []
            for x, y, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                left, right = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = np.concatenate([left, right])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                share = common / (len(left) + len(right) - common)
                if share >= similarity:
                    a.append(x)
                    b.append(y)
                    out.append(share)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.float64())], names=["sig_a", "sig_b", "similarity"])

    left = sets.select(F.col("sig").alias("sig_a"), F.col("elements").alias("left"))
    right = sets.select(F.col("sig").alias("sig_b"), F.col("elements").alias("right"))
    return pairs.join(left, "sig_a").join(right, "sig_b").select("sig_a", "sig_b", "left", "right").mapInArrow(run, "sig_a bigint, sig_b bigint, similarity double")


def class_links(chunks: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, links): (chunk_id, sig) of every text, repeated deliveries once, and (sig_a, sig_b, similarity) of classes.

    Texts of fewer than ``words`` words and null texts belong to no class.
    """
    texts = _texts(chunks)
    signed = cut(signatures(texts, frequencies(texts, words), similarity, words))
    members = signed.select("chunk_id", "sig").distinct()
    return members, verified(candidates(signed, similarity), class_sets(texts, words), similarity)


def similar_pairs(chunks: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """Every pair of different chunk_ids that is similar enough, the smaller id first: (chunk_id_a, chunk_id_b).

    This form expands classes to pairs, as p4_found asks; :func:`groups` keeps to one row per text.
    """
    members, links = class_links(chunks, similarity, words)
    a = members.select(F.col("sig").alias("sig_a"), F.col("chunk_id").alias("a"))
    b = members.select(F.col("sig").alias("sig_b"), F.col("chunk_id").alias("b"))
    across = links.select("sig_a", "sig_b").join(a, "sig_a").join(b, "sig_b").where("a <> b").select("a", "b")
    shared = members.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig", F.ceil(F.col("n") / BLOCK_COPIES).cast("int").alias("parts"))
    copies = members.join(shared, "sig")
    one = copies.select("sig", F.pmod(F.xxhash64("chunk_id"), F.col("parts")).cast("int").alias("part"), F.col("chunk_id").alias("a"))
    all_parts = copies.select("sig", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("chunk_id").alias("b"))
    within = one.join(all_parts, ["sig", "part"]).where("a < b").select("a", "b")
    return across.unionByName(within).select(F.least("a", "b").alias("chunk_id_a"), F.greatest("a", "b").alias("chunk_id_b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component of the links (a, b), for every node that has one.

    Alternating large-star and small-star steps; each round is written to the checkpoint folder, and what returns to the
    driver is one checksum per round.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def groups(chunks: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One row per chunk that has a near duplicate: (chunk_id, group_id, n_links); group_id is the group's least chunk_id,
    n_links the number of other chunk_ids similar enough to this one (copies included)."""
    members, links = class_links(chunks, similarity, words)
    links = cut(links.select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")))
    sizes = members.groupBy("sig").agg(F.count("*").alias("n"), F.min("chunk_id").alias("least_id"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both.join(sizes.select(F.col("sig").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("near"))
    roots = components(links)
    classes = sizes.join(roots.withColumnRenamed("node", "sig"), "sig", "left").join(around.withColumnRenamed("a", "sig"), "sig", "left")
    classes = classes.select("sig", F.coalesce("root", "sig").alias("root"), (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "least_id").where("n_links > 0")
    named = classes.join(classes.groupBy("root").agg(F.min("least_id").alias("group_id")), "root").select("sig", "group_id", "n_links")
    return members.join(named, "sig").select("chunk_id", "group_id", "n_links")
