"""Source identity, versions, immutable artifacts and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T


def source_key(agent, kind, path):
    """The identity of a source: agent and path folded, path separators as '/'."""
    return F.sha2(F.concat_ws("|", T.folded(agent), kind, T.folded(F.regexp_replace(path, r"\\", "/"))), 256)


def document_id(key):
    return F.concat(F.lit("doc-"), F.substring(key, 1, 24))


def latest_versions(manifests: DataFrame, keys: list[str], version: str = "source_version") -> DataFrame:
    """The row with the highest version number per key (v10 after v9); of equal numbers the latest created_at. Map-side
    combined, so a key with very many versions doesn't gather in one task."""
    order = F.struct(F.coalesce(T.version_number(version), F.lit(0)), F.col("created_at"), F.struct(*[c for c in manifests.columns if c not in (*keys, "created_at")]).cast("string"))
    row = F.struct(*manifests.columns)
    return manifests.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def resolve(sources: DataFrame, manifests: DataFrame, keys: list[str]) -> DataFrame:
    """For each incoming source (keys, source_hash, processing_key): action and version.

    'reuse' where the latest manifest has its hash and processing key and is validated; otherwise 'create' with the next
    version (v1 for a new source). Needs-review artifacts are never reused.
    """
    latest = latest_versions(manifests, keys).select(*keys, F.col("source_hash").alias("_hash"), F.col("processing_key").alias("_processing"), F.col("artifact_status").alias("_status"), F.col("source_version").alias("_version"))
    joined = sources.join(latest, keys, "left")
    same = (F.col("source_hash") == F.col("_hash")) & (F.col("processing_key") == F.col("_processing")) & F.col("_status").isin("validated", "ready")
    number = F.coalesce(T.version_number("_version"), F.lit(0))
    return joined.withColumn("action", F.when(same, "reuse").otherwise("create")).withColumn("version", F.when(same, F.col("_version")).otherwise(F.concat(F.lit("v"), (number + 1).cast("string")))).drop("_hash", "_processing", "_status", "_version")


def publish(rows: DataFrame, stored: DataFrame | None, keys: list[str], content: str) -> DataFrame:
    """The rows of an immutable store that are to be written: those whose keys aren't stored yet.

    Equal content is reused; other content under stored keys, or under one key within ``rows``, raises while the rows are
    written, and unsafe key parts do so too. Rows that repeat a key and its content count once.
    """
    own = rows.withColumn("artifact_hash", F.concat(F.lit("sha256:"), F.sha2(F.col(content), 256))).dropDuplicates([*keys, "artifact_hash"])
    for key in keys:
        own = own.withColumn(key, F.when(T.is_safe_component(key), F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"unsafe {key}: "), F.coalesce(F.col(key), F.lit("null"))))))
    twice = F.min("artifact_hash").over(Window.partitionBy(*keys)) != F.col("artifact_hash")
    clash = F.raise_error(F.concat(F.lit("two contents under one key: "), F.concat_ws("/", *keys))).cast("boolean")
    own = own.withColumn("_clash", twice).where(F.when(F.col("_clash"), clash).otherwise(True)).drop("_clash")
    if stored is None:
        return own
    before = stored.select(*keys, F.col("artifact_hash").alias("_stored"))
    joined = own.join(before, keys, "left")
    checked = F.when(F.col("_stored").isNull(), F.lit(True)).when(F.col("_stored") == F.col("artifact_hash"), F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("stored content differs: "), F.concat_ws("/", *keys))).cast("boolean"))
    return joined.where(checked).drop("_stored")


def verified(artifacts: DataFrame, content: str, stored_hash: str = "artifact_hash", least: int = 32) -> DataFrame:
    """Adds is_intact: whether the content has its stored SHA-256, with or without 'sha256:' in front; a shortened hash
    counts if it has at least ``least`` digits. Null content or hash isn't intact."""
    stored = F.lower(F.regexp_replace(F.col(stored_hash), "^sha256:", ""))
    same = F.startswith(F.sha2(F.col(content), 256), stored) & (F.char_length(stored) >= least)
    return artifacts.withColumn("is_intact", F.coalesce(same, F.lit(False)))


def relative_path(path, root: str):
    """A manifest's path below ``root`` with '/' as separator, whatever wrote it."""
    posix = F.regexp_replace(path, r"\\", "/")
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(posix, F.lit(prefix)), F.substring(posix, F.lit(len(prefix) + 1), F.char_length(posix))).otherwise(posix)
