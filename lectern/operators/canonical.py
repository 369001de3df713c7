"""Canonical documents as tables: nodes with their place, inherited state and provenance.

A canonical record is one JSON value, so whoever parses it has its whole tree: what a node inherits (breadcrumbs, blocks,
the parent's type) is settled in one pass over the record, without a shuffle. Everything after that is columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.operators.nested import parse_record

NODES = "artifact_id bigint, document_id string, ord int, node_id string, parent_id string, parent_ord int, parent_type string, depth int, node_type string, title string, text string, breadcrumbs array<string>, blocked boolean, review boolean, conflict boolean, n_children int, confidence double, node_document_id string, page_number string, slide_number string, sheet_name string, cell_range string, attributes string, gate boolean"


def plain(value) -> str:
    """A value as text with single blanks."""
    return " ".join(str(value).split()) if value is not None else ""


def objects(value) -> list[dict]:
    """The objects of a field that should be a list of them: a lone object counts as a list of one."""
    return [x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict)]


def field(node: dict, group: str, name: str):
    """A field of an object within a node, None where either is missing or of another kind."""
    inner = node.get(group)
    return inner.get(name) if isinstance(inner, dict) else None


@dataclass(slots=True)
class Placed:
    """A node where it stands: its order in the document, its parent, and what it inherits."""

    node: dict
    ord: int
    parent: Placed | None
    root_id: str
    depth: int
    crumbs: tuple[str, ...]
    review: bool
    conflict: bool
    blocked: bool

    @property
    def kind(self) -> str | None:
        return self.node.get("node_type")

    @property
    def parent_id(self) -> str:
        return self.parent.node.get("node_id") if self.parent else self.root_id


def document_title(document: dict) -> str | None:
    return field(document, "metadata", "title")


def walk(document: dict) -> Iterator[Placed]:
    """Every node of a document's tree in document order. A root counts as its own parent."""
    title = plain(document_title(document))
    waiting = [(root, None) for root in reversed(objects(document.get("root_nodes")))]
    count = 0
    while waiting:
        node, parent = waiting.pop()
        conflict = any(event.get("decision") == "conflict" for event in objects(field(node, "attributes", "reconciliation")))
        review = conflict or bool(field(node, "attributes", "requires_review")) or field(node, "attributes", "retrieval_allowed") is False
        before = parent.crumbs if parent else ((title,) if title else ())
        own = plain(node.get("title"))
        placed = Placed(node, count, parent, node.get("node_id"), parent.depth + 1 if parent else 0, (*before, own) if own else before, review, conflict, review or bool(parent and parent.blocked))
        yield placed
        count += 1
        waiting += [(child, placed) for child in reversed(objects(node.get("children")))]


def has_errors(document: dict) -> bool:
    return bool(field(document, "quality", "errors"))


def as_text(value) -> str | None:
    """A field as text; what ought to be text but isn't is written as JSON."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _number(value) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def rows_of(artifact_id: int, document: dict) -> Iterator[tuple]:
    for p in walk(document):
        node, source = p.node, p.node.get("provenance") if isinstance(p.node.get("provenance"), dict) else {}
        yield (
            artifact_id, as_text(document.get("document_id")), p.ord, as_text(node.get("node_id")), as_text(p.parent_id), p.parent.ord if p.parent else -1, as_text(p.parent.kind) if p.parent else None, p.depth,
            as_text(p.kind), plain(node.get("title")) or None, as_text(node.get("text")), list(p.crumbs), p.blocked, p.review, p.conflict, len(objects(node.get("children"))), _number(node.get("confidence")),
            as_text(source.get("document_id")), *(as_text(source.get(n)) for n in ("page_number", "slide_number", "sheet_name", "cell_range")), json.dumps(node["attributes"], ensure_ascii=False) if isinstance(node.get("attributes"), dict) else None, has_errors(document),
        )


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


def records(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, master_json) of the records with a key."""
    return artifacts.select(F.col("artifact_id").cast("bigint").alias("artifact_id"), F.col("master_json").cast("string").alias("master_json")).where(F.col("artifact_id").isNotNull())


def nodes(artifacts: DataFrame) -> DataFrame:
    """Every node of every stored document (``NODES``): its place in the tree, what it inherits, where it comes from.

    Null, blank, cut off and invalid records have no rows; a repeated delivery counts once. Other columns aren't read.
    """
    schema = arrow_schema(NODES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, record in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = parse_record(record.as_py())
                if isinstance(value, dict):
                    rows += rows_of(own, value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return records(artifacts).mapInArrow(run, NODES).dropDuplicates(["artifact_id", "ord"])


# ---- what follows from a node table, as columns ----


def inspection(found: DataFrame) -> DataFrame:
    """(artifact_id, n_nodes, n_blocked, n_conflicts, deepest, pages, slides, sheets, tables, n_sheets_named): the counts of each
    document, and how many sheets it draws on."""
    kind = F.col("node_type")
    return found.groupBy("artifact_id").agg(
        F.count("*").alias("n_nodes"), F.count_if("blocked").alias("n_blocked"), F.count_if("conflict").alias("n_conflicts"), F.max("depth").alias("deepest"),
        *[F.count_if(kind == name).alias(f"{name}s") for name in ("page", "slide", "sheet", "table")],
        F.count_distinct("sheet_name").alias("n_sheets_named"),
    )


def structure_check(counted: DataFrame, expected: DataFrame) -> DataFrame:
    """(artifact_id, kind, expected, actual, matches): structure counts against what an inventory says, kind by kind; kinds whose
    expectation is null aren't checked."""
    kinds = ("pages", "slides", "sheets", "tables")
    a = counted.select("artifact_id", *[F.col(k).alias(f"_{k}") for k in kinds])
    both = expected.select("artifact_id", *kinds).join(a, "artifact_id", "left")
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("bigint").alias("expected"), F.coalesce(F.col(f"_{k}"), F.lit(0)).cast("bigint").alias("actual")) for k in kinds])
    return both.select("artifact_id", F.inline(rows)).where(F.col("expected").isNotNull()).withColumn("matches", F.col("expected") == F.col("actual"))


def corpus_status(checks: DataFrame, coverage: DataFrame, warnings: DataFrame, least: float = 0.9) -> DataFrame:
    """(artifact_id, status): review_required below ``least`` coverage, with a structure that doesn't match, or with warnings;
    else passed. ``coverage``: (artifact_id, share), ``warnings``: (artifact_id, n)."""
    bad = checks.groupBy("artifact_id").agg(F.count_if(~F.col("matches")).alias("n_bad"))
    joined = coverage.select("artifact_id", "share").join(bad, "artifact_id", "full_outer").join(warnings.select("artifact_id", F.col("n").alias("n_warnings")), "artifact_id", "full_outer")
    doubtful = (F.coalesce("share", F.lit(1.0)) < least) | (F.coalesce("n_bad", F.lit(0)) > 0) | (F.coalesce("n_warnings", F.lit(0)) > 0)
    return joined.select("artifact_id", F.when(doubtful, "review_required").otherwise("passed").alias("status"))


def subtree_flags(found: DataFrame) -> DataFrame:
    """(artifact_id, node_id, n_review): of each top-level node how many nodes below and including it need review.

    The top-level node is the last one of depth 0 at or before a node in document order.
    """
    order = Window.partitionBy("artifact_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    top = found.withColumn("top", F.last(F.when(F.col("depth") == 0, F.col("node_id")), ignorenulls=True).over(order)).withColumn("top_ord", F.max(F.when(F.col("depth") == 0, F.col("ord"))).over(order))
    return top.groupBy("artifact_id", "top_ord", F.col("top").alias("node_id")).agg(F.count_if("review").alias("n_review")).select("artifact_id", "top_ord", "node_id", "n_review")


def subtree_text(found: DataFrame) -> DataFrame:
    """(artifact_id, top_ord, text): the texts of each top-level node and all below it, in document order, with single blanks."""
    order = Window.partitionBy("artifact_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    top = found.withColumn("top_ord", F.max(F.when(F.col("depth") == 0, F.col("ord"))).over(order)).withColumn("_t", T.normalised("text")).where(F.col("_t").isNotNull())
    joined = top.groupBy("artifact_id", "top_ord").agg(F.array_sort(F.collect_list(F.struct("ord", "_t"))).alias("_x"))
    return joined.select("artifact_id", "top_ord", F.array_join(F.transform("_x", lambda x: x["_t"]), " ").alias("text"))


def provenance_pushed_down(found: DataFrame) -> DataFrame:
    """Nodes without a page of their own take the page of the last node before them that is a page or has one."""
    order = Window.partitionBy("artifact_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    own = F.expr("try_cast(page_number AS int)")
    return found.withColumn("page_no", own).withColumn("inherited_page", F.coalesce("page_no", F.last("page_no", ignorenulls=True).over(order)))


def duplicate_table_prose(found: DataFrame, least_tokens: int = 12, share: float = 0.85) -> DataFrame:
    """(artifact_id, ord, table_text_coverage) of text nodes whose tokens a page's tables hold to at least ``share``, as multisets;
    such prose is kept for audit and left out of retrieval. Token counts are joined, so long texts cost what they hold."""
    pages = provenance_pushed_down(found).where(F.col("inherited_page").isNotNull())
    inside = F.col("node_type").isin("table", "table_header", "table_row", "table_cell")
    words = pages.select("artifact_id", "inherited_page", "ord", inside.alias("inside"), F.explode(T.tokens(F.coalesce("text", F.lit("")))).alias("token"))
    held = words.where("inside").groupBy("artifact_id", "inherited_page", "token").agg(F.count("*").alias("held"))
    own = words.where("not inside").groupBy("artifact_id", "inherited_page", "ord", "token").agg(F.count("*").alias("n"))
    met = own.join(held, ["artifact_id", "inherited_page", "token"], "left").groupBy("artifact_id", "ord").agg(F.sum("n").alias("total"), F.sum(F.least("n", F.coalesce("held", F.lit(0)))).alias("covered"))
    return met.where((F.col("total") >= least_tokens) & (F.col("covered") >= share * F.col("total"))).select("artifact_id", "ord", F.round(F.col("covered") / F.col("total"), 3).alias("table_text_coverage"))


def layout_tables(found: DataFrame) -> DataFrame:
    """(artifact_id, ord): tables of at most three cells in any row that need review and hold a requirement or example label;
    they are forms rather than data. A table's cells are the nodes between it and the next node as high as it."""
    order = Window.partitionBy("artifact_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    own = found.withColumn("table_ord", F.max(F.when(F.col("node_type") == "table", F.col("ord"))).over(order)).where(F.col("table_ord").isNotNull())
    wide = own.where(F.col("node_type") == "table_cell").groupBy("artifact_id", "table_ord", "parent_ord").agg(F.count("*").alias("n"), F.max(F.lower("text").rlike(r"\b(?:requirement|example)\(?s?\)?:")).alias("form"))
    tables = wide.groupBy("artifact_id", "table_ord").agg(F.max("n").alias("width"), F.max("form").alias("form"))
    flagged = found.where((F.col("node_type") == "table") & F.col("review")).select("artifact_id", "ord")
    return flagged.join(tables.where((F.col("width") <= 3) & F.col("form")).withColumnRenamed("table_ord", "ord"), ["artifact_id", "ord"]).select("artifact_id", "ord")


def node_references(found: DataFrame) -> DataFrame:
    """(artifact_id, ord, node_id, at, reference_id, status, reference): the references that nodes carry, one row each."""
    listed = F.from_json(F.get_json_object("attributes", "$.references"), "array<struct<reference_id string, status string, answer_eligible boolean>>")
    return found.select("artifact_id", "ord", "node_id", F.posexplode(listed).alias("at", "r")).select("artifact_id", "ord", "node_id", "at", "r.reference_id", "r.status", F.coalesce("r.answer_eligible", F.lit(False)).alias("answer_eligible"))


def empty_warnings(found: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(artifact_id, code): no_text for documents without any text, no_structure for those without a page, slide or sheet."""
    has = found.groupBy("artifact_id").agg(F.bool_or(T.normalised("text").isNotNull()).alias("texts"), F.bool_or(F.col("node_type").isin("page", "slide", "sheet")).alias("parts"))
    every = artifacts.select(F.col("artifact_id").cast("bigint").alias("artifact_id")).where(F.col("artifact_id").isNotNull()).distinct().join(has, "artifact_id", "left")
    missing = lambda name, code: F.when(~F.coalesce(F.col(name), F.lit(False)), F.lit(code))
    return every.select("artifact_id", F.explode(F.array_compact(F.array(missing("texts", "no_text"), missing("parts", "no_structure")))).alias("code"))


def fingerprinted(found: DataFrame, *columns: Column | str) -> DataFrame:
    """(artifact_id, n_nodes, digest): a checksum of the node table of each document, whatever order its rows come in."""
    return found.groupBy("artifact_id").agg(F.count("*").alias("n_nodes"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("digest"))
