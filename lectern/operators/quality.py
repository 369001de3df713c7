"""Quality issues of canonical nodes, folded messages and document status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.operators.blocks import NARRATIVE_TYPES


def issues(nodes: DataFrame) -> DataFrame:
    """(record_id, node_id, severity, code), one row per issue, in one pass plus two windows.

    ``nodes``: record_id, ord, node_id, parent_id, document_id, node_document_id, node_type, text, confidence, n_children,
    requires_review, conflict, structured, has_header, has_rows. Null flags count as false, a null confidence as fine.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    order = [F.col("ord")]
    same_id = F.row_number().over(Window.partitionBy("record_id", "node_id").orderBy(*order))
    told = F.col("text").isNotNull() & (F.col("text") != "") & F.col("node_type").isin(*NARRATIVE_TYPES)
    key = F.when(told, T.folded(F.regexp_replace("text", f"^{T.BLANK}+|{T.BLANK}+$", "")))
    ranked = nodes.withColumn("_id_no", same_id).withColumn("_key", key)
    ranked = ranked.withColumn("_text_no", F.when(told, F.row_number().over(Window.partitionBy("record_id", "node_type", "_key", "parent_id").orderBy(*order))))
    table = F.col("node_type") == "table"
    checks = (
        ("error", "duplicate_node_id", F.col("_id_no") > 1),
        ("error", "provenance_document_mismatch", F.col("node_document_id") != F.col("document_id")),
        ("warning", "empty_container", F.col("node_type").isin("page", "slide") & (F.col("n_children") == 0)),
        ("warning", "duplicate_content", F.col("_text_no") > 1),
        ("warning", "low_confidence", F.col("confidence") < 0.5),
        ("error", "extraction_conflict", flag("conflict")),
        ("warning", "unreadable_table", table & flag("requires_review")),
        ("warning", "incomplete_table", table & ~flag("structured") & ~(flag("has_header") & flag("has_rows"))),
    )
    found = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))) for severity, code, test in checks]))
    per_node = ranked.select("record_id", "node_id", F.explode(found).alias("i")).select("record_id", "node_id", "i.severity", "i.code")
    empty = nodes.groupBy("record_id").agg(F.max(F.coalesce(F.char_length(F.trim("text")), F.lit(0))).alias("most")).where("most = 0")
    return per_node.unionByName(empty.select("record_id", F.lit(None).cast("string").alias("node_id"), F.lit("error").alias("severity"), F.lit("no_extracted_content").alias("code")))


def folded_messages(found: DataFrame) -> DataFrame:
    """(record_id, errors, warnings): the distinct codes of each severity, sorted."""
    codes = lambda s: F.array_sort(F.collect_set(F.when(F.col("severity") == s, F.col("code"))))
    return found.groupBy("record_id").agg(codes("error").alias("errors"), codes("warning").alias("warnings"))


def status(documents: DataFrame, found: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, is_valid, n_errors, n_warnings) of every document; valid means without an error."""
    counted = found.groupBy(F.col("record_id").alias(key)).agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
    joined = documents.select(key).distinct().join(counted, key, "left")
    return joined.select(key, (F.coalesce("n_errors", F.lit(0)) == 0).alias("is_valid"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"), F.coalesce("n_warnings", F.lit(0)).alias("n_warnings"))


def cell_is_readable(row: str = "row", col: str = "col", row_span: str = "row_span", col_span: str = "col_span", n_rows: str = "n_rows", n_cols: str = "n_cols"):
    """Whether a structured cell lies within its table: offsets from 0, spans from 1, ends within the counts."""
    c = F.col
    return F.coalesce((c(row) >= 0) & (c(col) >= 0) & (c(row_span) >= 1) & (c(col_span) >= 1) & (c(row) + c(row_span) <= c(n_rows)) & (c(col) + c(col_span) <= c(n_cols)), F.lit(False))


#: Words of a technical context, and signs of an exponent that survived (fixed values).
QUANTITIES = r"(?i)\b(?:resistivity|conductivity|dielectric|thermal|expansion|coefficient|ohm|volume|surface)\b"
EXPONENT, DIGIT_RUN = r"10\s*(?:\^|[⁰¹²³⁴⁵⁶⁷⁸⁹])", r"\b10\d{3,}\b"


def suspicious_number(text):
    """A run of digits such as 101122 that has likely lost its exponent's sign, in a text on a physical quantity."""
    c = T.normalised(text)
    return F.coalesce(c.rlike(QUANTITIES) & ~c.rlike(EXPONENT) & c.rlike(DIGIT_RUN), F.lit(False))
