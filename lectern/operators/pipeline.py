"""The flows that put the parts together: ingest, persist, chunk, embed, index, audit.

Every step is a table in and a table out; a step that writes does so through Spark's job commit, so a lost executor or a
failed job leaves nothing half written, and what is there already is never written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import assembly, blocks, canonical, chunking, enrich, quality, registry, vectors
from lectern.plans.lineage import cut
from lectern.sources import office


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def persisted(rows: DataFrame, path: str, keys: list[str], content: str, partition: list[str] | None = None) -> int:
    """Writes the rows whose keys aren't stored below ``path`` yet, partitioned; the number written. Equal content under stored keys is
    reused, other content raises, and so do two contents under one key (:func:`lectern.operators.registry.publish`). One commit
    publishes all rows or none."""
    fresh = cut(registry.publish(rows, read_or_none(rows.sparkSession, path), keys, content))
    many = fresh.count()
    if many:
        writer = fresh.write.mode("append")
        (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return many


def persist_canonical(artifacts: DataFrame, path: str) -> int:
    """Canonical records (agent_id, document_id, source_version, master_json), immutable under their key."""
    return persisted(artifacts.select("agent_id", "document_id", "source_version", "master_json"), path, ["agent_id", "document_id", "source_version"], "master_json", ["agent_id"])


def persist_chunks(chunks: DataFrame, policy: chunking.Policy, path: str) -> int:
    """Chunks and their manifest, immutable under agent, document, version and policy version; the content compared is the list of
    chunk ids with their texts."""
    own = chunks.where(F.col("kind") == "chunk").withColumn("policy_version", F.lit(policy.version))
    keys = ["agent_id", "document_id", "source_version", "policy_version", "chunk_id"]
    return persisted(own.select(*keys, "chunk_type", "source_type", "parent_node_id", "source_node_ids", "content_text", "embedding_text", "metadata"), path, keys, "embedding_text", ["agent_id"])


def verified_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The stored chunks whose text still has its stored hash; any other raises while they are read."""
    own = registry.verified(spark.read.parquet(path), "embedding_text")
    return own.where(F.when(~F.col("is_intact"), F.raise_error(F.concat(F.lit("changed chunk: "), "chunk_id")).cast("boolean")).otherwise(True)).drop("is_intact")


def ingest(files: DataFrame, agent_id: str, extractors: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, issues) of files (path, content): parsed to blocks, put together to nodes, enriched with references and field uses,
    checked. A file that can't be read has an issue of severity error and no node."""
    found = cut(office.blocks(files, extractors))
    nodes = cut(assembly.block_nodes(found).withColumn("agent_id", F.lit(agent_id)))
    failed = found.where(F.col("kind") == "error").select(F.col("path").alias("record_id"), F.lit(None).cast("string").alias("node_id"), F.lit("error").alias("severity"), F.coalesce("error", F.lit("unreadable")).alias("code"))
    none = lambda t: F.lit(None).cast(t)
    checked = nodes.select(F.col("path").alias("record_id"), "ord", "node_id", "parent_id", F.col("path").alias("document_id"), F.col("path").alias("node_document_id"), "node_type", "text", none("double").alias("confidence"), F.when(F.col("parent_id").isNull(), 0).otherwise(1).alias("n_children"), F.lit(False).alias("requires_review"), F.lit(False).alias("conflict"), F.lit(False).alias("structured"), F.lit(True).alias("has_header"), F.lit(True).alias("has_rows"))
    return nodes, quality.issues(checked).where(F.col("code") != "empty_container").unionByName(failed)


def resolved_files(files: DataFrame, manifests: DataFrame, agent_id: str, processing_key: str) -> DataFrame:
    """Files (path, content) with source_hash, document_id and what to do: 'reuse' a validated version or 'create' the next one."""
    kind = F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1))
    keyed = files.withColumn("source_hash", T.file_hash("content")).withColumn("document_id", registry.document_id(registry.source_key(F.lit(agent_id), kind, F.col("path")))).withColumn("processing_key", F.lit(processing_key))
    return registry.resolve(keyed, manifests, ["document_id"])


def ingest_and_persist(files: DataFrame, manifests: DataFrame, agent_id: str, processing_key: str, path: str) -> DataFrame:
    """Ingests the files that changed and stores each one's nodes as one record under its next version; the manifest rows
    (document_id, source_version, source_hash, processing_key, artifact_status, created_at) of what was written."""
    todo = cut(resolved_files(files, manifests, agent_id, processing_key).where(F.col("action") == "create"))
    nodes, issues = ingest(todo.select("path", "content"), agent_id)
    fields = F.struct("ord", "node_id", "parent_id", "node_type", "text", "section_title")
    records = nodes.groupBy("path").agg(F.to_json(F.array_sort(F.collect_list(fields))).alias("master_json"))
    made = todo.select("path", "document_id", F.col("version").alias("source_version"), "source_hash", "processing_key").join(records, "path")
    persist_canonical(made.withColumn("agent_id", F.lit(agent_id)), path)
    bad = issues.where(F.col("severity") == "error").select(F.col("record_id").alias("path")).distinct().withColumn("_bad", F.lit(True))
    return made.join(bad, "path", "left").select("document_id", "source_version", "source_hash", "processing_key", F.when(F.col("_bad"), "requires_review").otherwise("validated").alias("artifact_status"), F.current_timestamp().alias("created_at"))


def branched(nodes: DataFrame) -> DataFrame:
    """Ingested nodes by branch, one row per node and branch."""
    return blocks.branches(nodes)


def index(artifacts: DataFrame, provider: vectors.Provider, model: str, dimensions: int, stored: DataFrame | None = None, policy: chunking.Policy = chunking.Policy()) -> DataFrame:
    """The vector index after the artifacts' chunks were built, verified, embedded and upserted, in this order; documents with
    errors have none."""
    chunks = cut(vectors.embeddable(chunking.chunk_artifacts(artifacts, policy)))
    wrong = chunking.problems(chunks).limit(1).collect()
    if wrong:
        raise ValueError(f"chunk {wrong[0]['chunk_id']}: {wrong[0]['code']}")
    points = vectors.checked_points(chunks, vectors.embed(chunks, provider, model, dimensions))
    return points if stored is None else vectors.upsert(stored, points)


def branch_tables(cells: DataFrame) -> DataFrame:
    """(table_name, column_name, position, n_values, kinds, use, answer_visible): the catalog of the tables that sheets hold
    (:func:`lectern.operators.workbook.table_rows`), each column with its types and what it may be used for."""
    columns = cells.groupBy("sheet_id", "table_name", "column_name").agg(F.min("col").alias("position"), F.count("*").alias("n_values"), F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kinds"))
    return enrich.field_policies(columns)


def branch_store(cells: DataFrame, path: str) -> None:
    """The rows of those tables, written partitioned by table: what structured queries read, one folder per table."""
    rows = cells.groupBy("sheet_id", "table_name", "row").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "value"))).alias("cells"))
    rows.write.mode("errorifexists").partitionBy("table_name").parquet(path)


def image_files(images: DataFrame, path: str) -> DataFrame:
    """(image_hash, extension, n): pictures (content, extension) stored once per content below ``path``; what was new."""
    hashed = images.where(F.col("content").isNotNull()).withColumn("image_hash", F.sha2("content", 256)).groupBy("image_hash").agg(F.first("content").alias("content"), F.min("extension").alias("extension"), F.count("*").alias("n"))
    held = read_or_none(images.sparkSession, path)
    fresh = cut(hashed if held is None else hashed.join(held.select("image_hash"), "image_hash", "left_anti"))
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(path)
    return fresh.select("image_hash", "extension", "n")


def corpus_report(inventory: DataFrame, results: DataFrame) -> DataFrame:
    """(source_type, n_files, n_passed, n_review, n_failed, n_unsupported, share_passed): a corpus run by type of file. Files of the
    inventory (path, source_type) without a result (path, status) count as failed; unsupported ones stay in the denominator."""
    joined = inventory.select("path", "source_type").join(results.select("path", "status"), "path", "left").withColumn("status", F.coalesce("status", F.lit("failed")))
    count = lambda s: F.count_if(F.col("status") == s)
    return joined.groupBy("source_type").agg(F.count("*").alias("n_files"), count("passed").alias("n_passed"), count("review_required").alias("n_review"), count("failed").alias("n_failed"), count("unsupported").alias("n_unsupported"), F.round(count("passed") / F.count("*"), 4).alias("share_passed"))


def save_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def canonical_text(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, text): all that a canonical document says, in order: texts, and the header rows of its tables."""
    nodes = canonical.nodes(artifacts)
    head = F.array_join(F.flatten(F.from_json(F.get_json_object("attributes", "$.header_rows"), "array<array<string>>")), " ")
    told = nodes.select("artifact_id", "ord", F.coalesce(T.normalised("text"), T.normalised(head)).alias("t")).where(F.col("t").isNotNull())
    return told.groupBy("artifact_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]), "\n").alias("text"))
