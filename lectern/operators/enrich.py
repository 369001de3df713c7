"""Field governance, reference and visual-asset registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.plans.lineage import broadcast_checked

# Column names that mark references and internal data.
REFERENCE_NAMES = r"(?i)\b(link|url|webinar|presentation|ppt|pdf|document path|file path|reference location)\b"
INTERNAL_NAMES = r"(?i)\b(internal note|backend|system field|record id|database id|created by|modified by|internal owner|record owner|system owner|email|password|token|secret)\b"
WARNED = ("unverified_remote", "missing_local", "unverified_network_path", "invalid")


def field_use(name: Column | str, strict: bool = True) -> Column:
    """standard, reference_link or internal_only by a column's name; a blank name counts as 'unlabelled_field'.

    ``strict`` also tests the name with its underscores as spaces, so that sanitised names don't leak internal data.
    """
    c = F.trim(F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit("")))
    label = F.when(c == "", "unlabelled_field").otherwise(c)
    spaced = F.replace(label, F.lit("_"), F.lit(" "))
    hit = lambda p: label.rlike(p) | (spaced.rlike(p) if strict else F.lit(False))
    return F.when(hit(REFERENCE_NAMES), "reference_link").when(hit(INTERNAL_NAMES), "internal_only").otherwise("standard")


def field_policies(cells: DataFrame, name: str = "column_name", overrides: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Adds use, retrieval_allowed and answer_visible to cells. ``overrides`` (field_name, use), if given, wins; it is
    joined on the folded name and broadcast only if small."""
    default = field_use(name, strict)
    if overrides is None:
        named = cells.withColumn("use", default)
    else:
        own = overrides.select(T.folded(F.trim("field_name")).alias("_name"), F.col("use").alias("_use")).dropDuplicates(["_name"])
        named = cells.withColumn("_name", T.folded(F.trim(F.coalesce(F.col(name), F.lit(""))))).join(broadcast_checked(own), "_name", "left").withColumn("use", F.coalesce("_use", default)).drop("_name", "_use")
    visible = F.col("use") != "internal_only"
    return named.withColumn("retrieval_allowed", visible).withColumn("answer_visible", visible)


def references(nodes: DataFrame, trusted: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """References of nodes (node_id, text, value, use): one row per node and reference id, the last one found of equal ids.

    ``trusted`` (host) and ``files`` (uri) say which hosts may be answered from and which files exist; nothing is
    connected to. Columns: node_id, reference_id, raw_value, normalized_uri, reference_type, status, answer_eligible,
    file_extension.
    """
    in_text = lambda c: F.coalesce(F.regexp_extract_all(F.col(c), F.lit(f"({T.URL})"), F.lit(1)), F.array().cast("array<string>"))
    whole = F.when((F.col("use") == "reference_link") & F.col("value").isNotNull(), F.array("value")).otherwise(F.array().cast("array<string>"))
    found = nodes.select("node_id", F.posexplode(F.concat(in_text("text"), in_text("value"), whole)).alias("at", "candidate")).withColumn("r", T.reference_of("candidate"))
    named = found.select("node_id", "at", "r.*").withColumn("reference_id", T.short_hash("ref_", 20, "node_id", F.coalesce("uri", "raw")))
    last = named.groupBy("node_id", "reference_id").agg(F.max_by(F.struct("raw", "uri", "kind", "scheme", "host", "extension"), "at").alias("r")).select("node_id", "reference_id", "r.*")
    hosts = trusted.select(F.lower("host").alias("host")).distinct().withColumn("_trusted", F.lit(True)) if trusted is not None else None
    last = last.join(broadcast_checked(hosts), "host", "left") if hosts is not None else last.withColumn("_trusted", F.lit(None).cast("boolean"))
    last = last.join(files.select("uri").distinct().withColumn("_there", F.lit(True)), "uri", "left") if files is not None else last.withColumn("_there", F.lit(None).cast("boolean"))
    network = F.col("raw").startswith("\\\\")
    status = (
        F.when(F.col("kind") == "unknown", "invalid")
        .when((F.col("kind") == "url") & F.col("_trusted").isNotNull(), "trusted_remote")
        .when(F.col("kind") == "url", "unverified_remote")
        .when(network, "unverified_network_path")
        .when(F.col("_there").isNotNull(), "available_local")
        .otherwise("missing_local")
    )
    return last.select("node_id", "reference_id", F.col("raw").alias("raw_value"), F.col("uri").alias("normalized_uri"), F.col("kind").alias("reference_type"), status.alias("status"), status.isin("trusted_remote", "available_local").alias("answer_eligible"), F.col("extension").alias("file_extension"))


def reference_warnings(found: DataFrame) -> DataFrame:
    """The distinct statuses that need a document warning, with their reference."""
    return found.where(F.col("status").isin(*WARNED)).select("status", F.coalesce("normalized_uri", "raw_value").alias("reference")).distinct()


def asset_status(ocr: Column, saved: Column) -> Column:
    return F.when(ocr.isin("success", "no_text", "failed"), F.concat(F.lit("ocr_"), ocr)).when(F.coalesce(saved, F.lit("")) != "", "stored").otherwise("metadata_only")


def visual_assets(images: DataFrame) -> DataFrame:
    """Assets of images (node_id, index, saved_path, xref, shape_name, image_type, extension, ocr_status)."""
    some = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    locator = F.coalesce(some("saved_path"), some("xref"), some("shape_name"))
    return images.select("node_id", T.short_hash("asset_", 20, "node_id", "index", locator).alias("asset_id"), F.coalesce(some("image_type"), some("extension"), F.lit("image")).alias("asset_type"), asset_status(F.col("ocr_status"), F.col("saved_path")).alias("status"), locator.alias("locator"))


def needs_vision(scope: str, flagged: Column, ocr_text: Column) -> Column:
    """Whether an image is described: scope 'all', 'vision_candidates' (flagged ones) or 'candidates' (also those without text)."""
    if scope == "all":
        return F.lit(True)
    return F.coalesce(flagged, F.lit(False)) if scope == "vision_candidates" else F.coalesce(flagged, F.lit(False)) | T.normalised(ocr_text).isNull()
