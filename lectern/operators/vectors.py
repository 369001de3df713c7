"""Embedding, validation, storage and exact search of vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T

#: Fixed values of the embedding contract.
BATCH, RETRIES, FIRST_DELAY = 16, 3, 0.75
#: Queries that one pass compares with every vector.
QUERY_BLOCK = 4_096

Provider = Callable[[list[str]], list[list[float]]]


def hashed_provider(dimensions: int = 64) -> Provider:
    """A deterministic offline provider: signed feature hashing of words, unit length."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dimensions), np.float32)
        for row, text in enumerate(texts):
            for word in text.lower().split():
                digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
                out[row, int.from_bytes(digest[:4], "little") % dimensions] += 1 if digest[4] & 1 else -1
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norms == 0, 1, norms)).tolist()

    return embed


def with_retries(provider: Provider, retries: int = RETRIES, delay: float = FIRST_DELAY, sleep: Callable[[float], None] | None = None) -> Provider:
    """The provider, tried again after ``delay * 2**n``; the last error names only its type."""
    import time

    pause = sleep or time.sleep

    def call(texts: list[str]) -> list[list[float]]:
        for attempt in range(retries):
            try:
                return provider(texts)
            except Exception as error:
                if attempt == retries - 1:
                    raise RuntimeError(f"embedding failed: {type(error).__name__}") from None
                pause(delay * 2**attempt)
        return []

    return call


def embed(chunks: DataFrame, provider: Provider, model: str, dimensions: int, batch_size: int = BATCH, retries: int = RETRIES, delay: float = FIRST_DELAY) -> DataFrame:
    """(chunk_id, embedding, embedding_model, dimensions) of every chunk with text; blank texts have no row.

    A wrong number of vectors or a wrong width raises. The provider runs per partition, ``batch_size`` texts a call, and is
    tried again where it fails; results are taken in the order of the texts.
    """
    provider = with_retries(provider, retries, delay)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for low in range(0, len(texts), batch_size):
                part = texts[low : low + batch_size]
                made = provider(part)
                if len(made) != len(part) or any(len(v) != dimensions for v in made):
                    raise ValueError("the provider returned other vectors than asked for")
                vectors += made
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(vectors, pa.list_(pa.float32())), pa.array([model] * len(ids)), pa.array([dimensions] * len(ids), pa.int32())], names=["chunk_id", "embedding", "embedding_model", "dimensions"])

    own = chunks.select(F.col("chunk_id").cast("string").alias("chunk_id"), T.normalised("embedding_text").alias("_n"), "embedding_text").where(F.col("chunk_id").isNotNull() & F.col("_n").isNotNull())
    return own.select("chunk_id", "embedding_text").mapInArrow(run, "chunk_id string, embedding array<float>, embedding_model string, dimensions int")


LINEAGE = ("document_id", "agent_id", "source_type", "source_version", "parent_node_id", "chunk_type")


def with_lineage(embedded: DataFrame, chunks: DataFrame) -> DataFrame:
    """Vectors with ``metadata``, the six lineage fields of their chunks as JSON."""
    own = chunks.select("chunk_id", F.to_json(F.struct(*LINEAGE)).alias("metadata")).dropDuplicates(["chunk_id"])
    return embedded.join(own, "chunk_id")


def embeddable(chunks: DataFrame) -> DataFrame:
    """The chunks of records without a rejection of severity error (rows of ``chunking.chunk_artifacts``): a record with one has
    none of its chunks embedded."""
    stopped = chunks.where((F.col("kind") == "rejection") & (F.col("severity") == "error")).select("artifact_id").distinct()
    return chunks.where(F.col("kind") == "chunk").join(stopped, "artifact_id", "left_anti")


def is_valid(vector: str, dimensions: str) -> Column:
    """Exactly ``dimensions`` values, none null or not finite, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == F.col(dimensions)) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays, in double precision, element by element in order."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, access: Column) -> DataFrame:
    """(query, key, similarity, rank): the exact k most similar vectors of each query, itself excluded; ties by key.

    ``access`` filters the vectors before the search (``retrieval.Caller``; ``retrieval.unscoped()`` for tables without scopes).

    Queries go out in blocks of ``QUERY_BLOCK``, each compared with all vectors in one pass that keeps k per partition, so
    what is sent and kept is bounded whatever the number of queries or vectors.
    """
    spark, vectors = vectors.sparkSession, vectors.where(F.coalesce(access, F.lit(False)))
    asked = queries.select(key, vector).where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    blocks = max(1, -(-asked.count() // (QUERY_BLOCK // 2)))
    out = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == block).collect() if blocks > 1 else asked.collect()
        if not rows:
            continue
        ids = [r[key] for r in rows]
        sent = spark.sparkContext.broadcast((ids, np.array([r[vector] for r in rows], np.float64)))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, q = sent.value
            q = q / np.linalg.norm(q, axis=1, keepdims=True)
            best: list[list[tuple]] = [[] for _ in names]
            for batch in batches:
                own = batch.column(0).to_pylist()
                x = np.array(batch.column(1).to_pylist(), np.float64)
                cos = q @ (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).T
                cos = np.round(cos, 12)
                for at, name in enumerate(names):
                    least = best[at][k - 1][0] if len(best[at]) >= k else 2.0
                    take = np.flatnonzero(-cos[at] <= least)
                    if len(take) > 4 * k:
                        edge = np.partition(cos[at][take], len(take) - k - 1)[len(take) - k - 1]
                        take = take[cos[at][take] >= edge]
                    held = best[at] + [(-float(cos[at][i]), own[i]) for i in take if own[i] != name]
                    held.sort()
                    best[at] = held[:k]
            rows = [(name, other, -c) for name, held in zip(names, best) for c, other in held]
            a, b, c = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind), pa.array(c, pa.float64())], names=["query", key, "similarity"])

        kind = pa.int64() if isinstance(ids[0], int) else pa.string()
        name = "bigint" if isinstance(ids[0], int) else "string"
        found = vectors.select(F.col(key).cast(name).alias(key), vector).where(F.col(key).isNotNull() & F.col(vector).isNotNull()).mapInArrow(run, f"query {name}, {key} {name}, similarity double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vectors.select(F.col(key).alias("query"), key, F.lit(0.0).alias("similarity"), F.lit(0).alias("rank")).limit(0)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), key)))
    return ranked.where(F.col("rank") <= k)


def point_id(chunk_id: Column | str) -> Column:
    return T.uuid5(chunk_id)


def payload(chunks: DataFrame, embedded: DataFrame) -> DataFrame:
    """What a vector index stores: the chunk's vector with its lineage and scope, one row per chunk and model.

    An inner join on chunk_id; use :func:`unknown_vectors` to refuse vectors of chunks that don't exist.
    """
    scope = lambda name: F.coalesce(F.from_json(F.get_json_object("metadata", f"$.security_scope.{name}"), "array<string>"), F.array().cast("array<string>"))
    own = chunks.select("chunk_id", "document_id", "agent_id", "source_version", "chunk_type", "parent_node_id", F.coalesce(F.get_json_object("metadata", "$.security_scope.classification"), F.lit("internal")).alias("classification"), scope("allowed_groups").alias("allowed_groups"), scope("allowed_users").alias("allowed_users")).dropDuplicates(["chunk_id"])
    vectors = embedded.where(is_valid("embedding", "dimensions")).select("chunk_id", "embedding_model", "dimensions", "embedding").dropDuplicates(["chunk_id", "embedding_model"])
    return vectors.join(own, "chunk_id").withColumn("point_id", point_id("chunk_id")).withColumn("collection", T.collection_name("agent_id"))


def unknown_vectors(chunks: DataFrame, embedded: DataFrame) -> DataFrame:
    """The chunk_ids that have a vector but no chunk."""
    return embedded.select("chunk_id").where(F.col("chunk_id").isNotNull()).distinct().join(chunks.select("chunk_id"), "chunk_id", "left_anti")


def checked_points(chunks: DataFrame, embedded: DataFrame) -> DataFrame:
    """The rows of :func:`payload`, refused as a whole where a vector has no chunk, no text or isn't valid; the check comes before
    anything is joined."""
    known = embedded.select("chunk_id", "embedding_model", is_valid("embedding", "dimensions").alias("_ok")).join(chunks.select("chunk_id", (T.normalised("content_text").isNotNull()).alias("_told")).dropDuplicates(["chunk_id"]), "chunk_id", "left")
    fault = F.when(F.col("_told").isNull(), "unknown chunk: ").when(~F.col("_told"), "empty chunk: ").when(~F.col("_ok"), "invalid vector: ")
    bad = known.where(fault.isNotNull()).select(F.concat(fault, "chunk_id").alias("fault")).limit(1).collect()
    if bad:
        raise ValueError(bad[0]["fault"])
    return payload(chunks, embedded)


#: What an index is made with: its metric and the fields that filters use (fixed values).
METRIC, INDEXED = "cosine", ("document_id", "agent_id", "source_version", "chunk_type", "classification", "allowed_groups")


def ensure_collection(path: str, spark, name: str, dimensions: int) -> dict:
    """The description of a collection below ``path``, made where it is missing; another width or metric under its name raises."""
    folder, wanted = f"{path}/{name}/_collection", (name, METRIC, dimensions, ",".join(INDEXED))
    schema = "name string, metric string, dimensions int, indexed string"
    try:
        held = tuple(spark.read.schema(schema).json(folder).first())
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        spark.createDataFrame([wanted], schema).coalesce(1).write.mode("errorifexists").json(folder)
        held = wanted
    if held != wanted:
        raise ValueError(f"collection {name} is there with {held[1]} of {held[2]} values")
    return dict(zip(("name", "metric", "dimensions", "indexed"), held))


def upsert(stored: DataFrame, rows: DataFrame, key: str = "point_id") -> DataFrame:
    """The index after an upsert: stored points whose key isn't given anew, and the new ones (a repeated key once)."""
    return stored.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows.dropDuplicates([key]))


def without_version(stored: DataFrame, documents: DataFrame) -> DataFrame:
    """The index without the points of the given (document_id, source_version)."""
    return stored.join(documents.select("document_id", "source_version").distinct(), ["document_id", "source_version"], "left_anti")
