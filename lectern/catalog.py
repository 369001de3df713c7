"""The core's registered queries; :mod:`lectern.oracles` has their equivalents in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import oracles
from lectern.functions import compare
from lectern.functions import text as T
from lectern.operators import assembly, blocks, canonical, chunking, enrich, nested, quality, reconcile, registry, retrieval, vectors, workbook
from lectern.plans.guard import guarded_sql
from lectern.sources.tables import table
from lectern.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

#: Search texts of the retrieval queries (parameters).
SEARCHES = (("q1", "torque audit of the busbar"), ("q2", "shaker run gasket leaked"), ("q3", "Dichtung nach dem Lackieren gerissen"))


#: For whom the chunk searches are done (a parameter).
CALLER = retrieval.Caller(("grp-brake", "grp-thermal", "grp-harness"))


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _searches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEARCHES), "query_id string, query_text string")


# ---- nested records ----


def p3_found(spark, folder):
    return nested.node_links(table(spark, folder, "canonical_artifacts"), table(spark, folder, "extraction_results"))


def p3_nodes(spark, folder):
    return nested.nodes_flat(table(spark, folder, "canonical_artifacts"), table(spark, folder, "extraction_results"))


def p3_tables(spark, folder):
    return nested.table_sizes(table(spark, folder, "canonical_artifacts"), table(spark, folder, "extraction_results"))


def canonical_nodes(spark, folder):
    """The nodes of stored documents with their place and what they inherit."""
    found = canonical.nodes(table(spark, folder, "canonical_artifacts"))
    return found.select("artifact_id", "ord", "node_id", "parent_ord", "depth", "node_type", "n_children", "blocked", "page_number")


def node_inspection(spark, folder):
    return canonical.inspection(canonical.nodes(table(spark, folder, "canonical_artifacts"))).select("artifact_id", "n_nodes", "n_blocked", "deepest", "pages", "slides", "sheets", "tables")


def subtree_flags(spark, folder):
    return canonical.subtree_flags(canonical.nodes(table(spark, folder, "canonical_artifacts")))


def node_references(spark, folder):
    found = canonical.node_references(canonical.nodes(table(spark, folder, "canonical_artifacts")))
    return found.select("artifact_id", "ord", "at", "reference_id", "status")


def canonical_branches(spark, folder):
    """Real nodes of all types by branch; table rows stand in two."""
    return blocks.branches(canonical.nodes(table(spark, folder, "canonical_artifacts"))).groupBy("branch", "node_type").agg(F.count("*").alias("n"))


def _elements(spark, folder):
    return assembly.export_elements(nested.emit_tagged(table(spark, folder, "extraction_results"), "extraction_id", "exported", "exported", "self_ref"))


def export_elements(spark, folder):
    return _elements(spark, folder).select("record_id", "self_ref", "label", "page_no", F.char_length("text").alias("chars"))


def missing_pages(spark, folder):
    """Pages that the exported tree of an extraction has no element of."""
    expected = table(spark, folder, "extraction_results").select(F.col("extraction_id").alias("record_id"), "page_count").distinct()
    return reconcile.missing_pages(expected, _elements(spark, folder), ["record_id"]).groupBy("record_id").agg(F.count("*").alias("n_missing"))


# ---- text rules ----


def text_normalised(spark, folder):
    n = T.normalised("text")
    return _docs(spark, folder).select("doc_id", F.char_length(n).alias("n_chars_normalised"), F.substring(F.sha2(n, 256), 1, 16).alias("digest"))


def token_counts(spark, folder):
    return blocks.token_counts(_docs(spark, folder), "text")


def token_topk(spark, folder):
    return blocks.token_counts(_docs(spark, folder), "text", "lang").where(F.col("lang").isNotNull()).groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "token"))), 1, 15).alias("t")).select("lang", F.inline("t")).select("lang", "token", (-F.col("n")).alias("n"))


def technical_values(spark, folder):
    return _docs(spark, folder).select("doc_id", F.array_join(T.technical_values("text"), "|").alias("technical_values"))


def text_compared(spark, folder):
    """Each chunk's text against its embedding text and against altered copies of itself."""
    c = table(spark, folder, "chunks").select("chunk_id", "content_text", "embedding_text").distinct()
    return c.select("chunk_id", compare.compared("embedding_text", "content_text").alias("content_in_embedding"), compare.compared("content_text", F.upper("content_text")).alias("against_upper"), compare.compared("content_text", F.replace(F.col("content_text"), F.lit("1"), F.lit("7"))).alias("against_altered"))


def headings_and_bullets(spark, folder):
    lines = blocks.lines(_docs(spark, folder), "doc_id", "text")
    return lines.select("doc_id", "line_no", T.is_heading("line").alias("is_heading"), T.is_bullet("line").alias("is_bullet"), T.heading_text("line").alias("heading_text"), T.bullet_text("line").alias("bullet_text"))


def inferred_titles(spark, folder):
    return _docs(spark, folder).select("doc_id", T.inferred_title("text", F.coalesce("document_title", F.lit("untitled"))).alias("title"))


def lines_to_nodes(spark, folder):
    return blocks.lines_to_nodes(_docs(spark, folder), "doc_id", "text")


def section_carry_forward(spark, folder):
    return blocks.with_sections(lines_to_nodes(spark, folder), "doc_id").groupBy("doc_id", "section_no", "section_title").agg(F.count("*").alias("n_nodes"))


def branch_nodes(spark, folder):
    return blocks.branches(lines_to_nodes(spark, folder)).groupBy("branch", "node_type").agg(F.count("*").alias("n"))


def _markdown(spark, folder):
    return table(spark, folder, "extraction_results").select("extraction_id", "markdown").where(F.col("markdown").isNotNull()).distinct()


def markdown_sections(spark, folder):
    s = blocks.markdown_sections(_markdown(spark, folder), "extraction_id", "markdown")
    return s.select("extraction_id", "section_no", F.char_length("section").alias("n_chars"))


def markdown_blocks(spark, folder):
    return blocks.markdown_blocks(_markdown(spark, folder), "extraction_id", "markdown").select("extraction_id", "block_no", F.char_length("block").alias("n_chars"))


def duplicate_content(spark, folder):
    d = _docs(spark, folder).where(F.col("text").isNotNull()).withColumn("digest", F.sha2(T.folded(T.normalised("text")), 256))
    return blocks.repeats(d, F.col("digest"), ["doc_id"]).select("doc_id", "occurrence")


def multiset_difference(spark, folder):
    d = _docs(spark, folder)
    a = d.select(T.normalised("source").alias("source"), "lang")
    return a.exceptAll(d.select("source", "lang"))


def multiset_intersection(spark, folder):
    d = _docs(spark, folder)
    return d.select(T.normalised("source").alias("source"), "lang").intersectAll(d.select("source", "lang"))


def missing_tokens(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "content_text", "embedding_text").distinct()
    return blocks.missing_tokens(c, c, "embedding_text", "content_text")


def coverage_by_document(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "content_text", "embedding_text").distinct()
    return blocks.coverage_by_key(c, c, "document_id", "embedding_text", "content_text")


def phrase_matches(spark, folder):
    phrase = F.array(F.lit("torque"), F.lit("audit"))
    return _docs(spark, folder).where(reconcile.contains_sequence(T.tokens("text"), phrase)).select("doc_id")


def measurements(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", T.measurement(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" kg"))).alias("m")).groupBy("m.unit").agg(F.sum("m.value").alias("total"), F.count("*").alias("n"))


def time_budgets(spark, folder):
    pages = F.greatest(F.lit(1), F.ceil(F.coalesce("n_chars", F.lit(0)) / 20)).cast("int")
    return _docs(spark, folder).select("doc_id", pages.alias("pages"), T.attempt_seconds(pages).alias("first_s"), T.attempt_seconds(pages, True).alias("first_ocr_s"), T.retry_seconds(T.attempt_seconds(pages)).alias("retry_s"))


def suspicious_numbers(spark, folder):
    """Chunks whose numbers, once their exponent signs are lost, are suspicious in a technical context."""
    c = table(spark, folder, "chunks").select("chunk_id", "content_text").where(F.col("content_text").isNotNull()).distinct()
    broken = F.regexp_replace("content_text", r"([0-9]+)", "10$1")
    word = F.when(F.substring("chunk_id", -1, 1) < "8", F.concat(F.lit("Volume of "), broken)).otherwise(broken)
    return c.select("chunk_id", quality.suspicious_number(word).alias("is_suspicious"))


# ---- reconciliation ----


def page_base(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "chunk_type", "content_text", "embedding_text").distinct()

    def scored(text):
        chars = F.sum(F.coalesce(F.char_length(text), F.lit(0)))
        tables = F.count_if(F.col("chunk_type") == "table_row")
        return c.where(F.col(text).isNotNull()).groupBy("document_id").agg(chars.alias("chars"), T.page_score(chars, F.count("*"), tables, F.lit(0), F.lit(False)).alias("score"), tables.alias("n_tables"))

    return reconcile.pair_pages(scored("content_text"), scored("embedding_text"), ["document_id"]).select("document_id", "a_score", "b_score", "base")


def page_text_fold(spark, folder):
    """The blocks of each document's chunks merged into its first chunk's text, in order."""
    from pyspark.sql.window import Window

    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "parent_node_id", "content_text").where(F.col("content_text").isNotNull()).distinct()
    w = Window.partitionBy("document_id", "parent_node_id").orderBy("chunk_id")
    numbered = c.withColumn("block_no", F.row_number().over(w)).withColumn("base_text", F.first("content_text").over(w))
    return reconcile.merge_page_text(numbered.where("block_no > 1").select("document_id", "parent_node_id", "block_no", "base_text", F.col("content_text").alias("block_text")), ["document_id", "parent_node_id"])


def outcome_summary(spark, folder):
    return reconcile.outcome_summary(page_text_fold(spark, folder), ["document_id"])


def table_compared(spark, folder):
    li = table(spark, folder, "lineitem")
    cells = lambda *texts: li.select("l_orderkey", F.col("l_linenumber").alias("row"), F.posexplode(F.array(*texts)).alias("col", "text"))
    changed = F.when(F.col("l_quantity") > 45, "X").when(F.col("l_quantity") > 40, "").otherwise(F.col("l_linestatus"))
    return reconcile.compare_cells(cells(F.col("l_returnflag"), F.col("l_linestatus")), cells(F.col("l_returnflag"), changed), ["l_orderkey"]).groupBy("decision").agg(F.count("*").alias("n_tables"), F.sum("conflicts").alias("n_conflicts"))


def _boxes(spark, folder, shift):
    return table(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber"), (F.col("l_quantity") + shift).alias("left"), (F.col("l_tax") * 100 + shift).alias("top"), F.lit(10.0).alias("width"), F.lit(5.0).alias("height"))


def best_overlap(spark, folder):
    a = _boxes(spark, folder, 0.0).withColumnRenamed("l_linenumber", "target_id")
    b = _boxes(spark, folder, 1.0).withColumnRenamed("l_linenumber", "block_id")
    return reconcile.best_overlap(a, b, ["l_orderkey"]).withColumn("area", F.round("area", 6))


def words_in_box(spark, folder):
    words = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 2).alias("x1"), (F.col("l_tax") * 100).alias("y0"), (F.col("l_tax") * 100 + 1).alias("y1"), F.col("l_partkey").cast("string").alias("word"), F.col("l_linenumber").alias("ord"))
    boxes = _boxes(spark, folder, 0.5).withColumnRenamed("l_linenumber", "box_id")
    return reconcile.words_in_box(words, boxes, ["l_orderkey"])


# ---- governance ----


def _cells(spark, folder):
    c = workbook.long_cells(table(spark, folder, "customer"), ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return c


def field_policy_cells(spark, folder):
    labels = {"c_name": "customer_email", "c_nationkey": "Reference Link", "c_acctbal": "internal_note", "c_mktsegment": "Segment"}
    named = F.col("column_name")
    for old, new in labels.items():
        named = F.when(F.col("column_name") == old, new).otherwise(named)
    overrides = spark.createDataFrame([("Segment", "reference_link")], "field_name string, use string")
    cells = _cells(spark, folder).withColumn("column_name", named)
    return enrich.field_policies(cells, overrides=overrides).groupBy("column_name", "use", "answer_visible").agg(F.count("*").alias("n"))


def reference_registry(spark, folder):
    n = _markdown(spark, folder).select(F.col("extraction_id").alias("node_id"), F.col("markdown").alias("text"), F.lit(None).cast("string").alias("value"), F.lit("standard").alias("use"))
    trusted = spark.createDataFrame([("docs.plant7.example",), ("docs.plant20.example",)], "host string")
    return enrich.references(n, trusted)


def visual_assets(spark, folder):
    found = _markdown(spark, folder).select(F.col("extraction_id").alias("node_id"), F.posexplode(F.regexp_extract_all("markdown", F.lit(r"!\[[^\]]*\]\(([^)]*)\)"), F.lit(1))).alias("at", "saved_path"))
    none = F.lit(None).cast("string")
    images = found.select("node_id", (F.col("at") + 1).alias("index"), "saved_path", none.alias("xref"), none.alias("shape_name"), F.lit("png").alias("image_type"), none.alias("extension"), none.alias("ocr_status"))
    return enrich.visual_assets(images)


# ---- quality ----


def _chunk_nodes(spark, folder):
    c = table(spark, folder, "chunks")
    return c.select(F.col("document_id").alias("record_id"), F.col("created_at").alias("ord"), F.col("chunk_id").alias("node_id"), F.col("parent_node_id").alias("parent_id"), "document_id", F.col("document_id").alias("node_document_id"), F.when(F.col("chunk_type") == "table_row", "table").otherwise("paragraph").alias("node_type"), F.col("content_text").alias("text"), F.lit(None).cast("double").alias("confidence"), F.lit(0).alias("n_children"), (F.col("policy_version").isNull()).alias("requires_review"), F.lit(False).alias("conflict"), F.lit(False).alias("structured"), F.lit(True).alias("has_header"), F.col("content_text").isNotNull().alias("has_rows"))


def quality_issues(spark, folder):
    return quality.issues(_chunk_nodes(spark, folder)).groupBy("record_id", "severity", "code").agg(F.count("*").alias("n"))


def quality_status(spark, folder):
    nodes = _chunk_nodes(spark, folder)
    return quality.status(nodes, quality.issues(nodes))


# ---- chunks ----


def artifact_chunks(spark, folder):
    return chunking.chunk_artifacts(table(spark, folder, "canonical_artifacts"))


def artifact_manifests(spark, folder):
    return chunking.manifests(artifact_chunks(spark, folder))


def chunk_problems(spark, folder):
    return chunking.problems(table(spark, folder, "chunks"))


def chunk_statistics(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "chunk_type", "policy_version", "content_text").distinct()
    return c.groupBy("chunk_type", "policy_version").agg(F.count("*").alias("n_chunks"), F.max(F.char_length("content_text")).alias("longest"), F.sum(F.char_length("content_text")).alias("chars"))


def context_prefixes(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "metadata", "document_id").distinct()
    crumbs = F.from_json(F.get_json_object("metadata", "$.breadcrumbs"), "array<string>")
    return c.where(crumbs.isNotNull()).select("chunk_id", T.context_prefix(F.col("document_id"), crumbs).alias("prefix"))


# ---- registry ----


def _manifests(spark, folder):
    return table(spark, folder, "canonical_artifacts").select("document_id", "source_version", "source_hash", "processing_key", "artifact_status", "created_at", "artifact_id")


def latest_versions(spark, folder):
    return registry.latest_versions(_manifests(spark, folder), ["document_id"]).select("document_id", "source_version", "artifact_id")


def resolved_sources(spark, folder):
    m = _manifests(spark, folder)
    incoming = m.select("document_id", "source_hash", "processing_key").distinct()
    return registry.resolve(incoming, m, ["document_id"])


def intact_artifacts(spark, folder):
    return registry.verified(table(spark, folder, "canonical_artifacts"), "master_json").select("artifact_id", "is_intact").distinct()


def source_keys(spark, folder):
    key = registry.source_key(F.coalesce("agent_id", F.lit("")), F.lit("text"), F.coalesce("source_key", F.lit("")))
    return _docs(spark, folder).select("doc_id", key.alias("key"), registry.document_id(key).alias("document_id"))


# ---- vectors ----


def vector_topk(spark, folder):
    e = table(spark, folder, "embeddings")
    return vectors.top_k(e, e.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding", 10, retrieval.unscoped()).select("query", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


def vector_validity(spark, folder):
    e = table(spark, folder, "embedded_chunks").select("chunk_id", "embedding_model", "dimensions", "embedding").dropDuplicates(["chunk_id"])
    return e.select("embedding_model", vectors.is_valid("embedding", "dimensions").alias("is_valid")).groupBy("embedding_model", "is_valid").agg(F.count("*").alias("n"))


def vector_payload(spark, folder):
    p = vectors.payload(table(spark, folder, "chunks"), table(spark, folder, "embedded_chunks"))
    return p.select("chunk_id", "embedding_model", "document_id", "agent_id", "source_version", "classification", F.array_join("allowed_groups", "|").alias("allowed_groups"), "collection")


def unknown_vectors(spark, folder):
    return vectors.unknown_vectors(table(spark, folder, "chunks"), table(spark, folder, "embedded_chunks"))


def embedded_offline(spark, folder):
    """Chunks through the offline provider; only widths and norms are reported."""
    made = vectors.embed(table(spark, folder, "chunks").select("chunk_id", "embedding_text").distinct(), vectors.hashed_provider(32), "hashed-32", 32)
    return made.select("chunk_id", "embedding_model", F.size("embedding").alias("width"))


# ---- retrieval ----


def permitted_chunks(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "agent_id", "metadata").distinct()
    return c.where(retrieval.Caller(("grp-brake", "grp-thermal")).may_read()).groupBy("agent_id").agg(F.count("*").alias("n_chunks"))


def bm25_topk(spark, folder):
    return retrieval.bm25(_docs(spark, folder), "doc_id", "text", _searches(spark), retrieval.unscoped(), 10).select("query_id", "doc_id", F.round("score", 4).alias("score"))


def rrf_fusion(spark, folder):
    body = retrieval.bm25(_docs(spark, folder), "doc_id", "text", _searches(spark), retrieval.unscoped(), 20)
    title = retrieval.bm25(_docs(spark, folder), "doc_id", "document_title", _searches(spark), retrieval.unscoped(), 20)
    return retrieval.fused([body, title], "doc_id", 10)


def _seeds(spark, folder):
    """Three stored chunks with a vector as queries: their text and their vector (the least ids)."""
    e = table(spark, folder, "embedded_chunks").where((F.col("embedding_model") == "dense-std-64") & vectors.is_valid("embedding", "dimensions")).select("chunk_id", "embedding").dropDuplicates(["chunk_id"])
    c = table(spark, folder, "chunks").where(F.col("content_text").isNotNull()).select("chunk_id", "content_text").dropDuplicates(["chunk_id"])
    return e, e.join(c, "chunk_id").orderBy("chunk_id").limit(3)


def hybrid_fusion(spark, folder):
    """Lexical and vector search for the same three queries, for one caller, fused by reciprocal rank."""
    e, seeds = _seeds(spark, folder)
    c = table(spark, folder, "chunks").select("chunk_id", "content_text", "metadata").distinct()
    lexical = retrieval.bm25(c, "chunk_id", "content_text", seeds.select(F.col("chunk_id").alias("query_id"), F.col("content_text").alias("query_text")), CALLER.may_read(), 20)
    scoped = e.join(c.select("chunk_id", "metadata"), "chunk_id")
    near = vectors.top_k(scoped, seeds, "chunk_id", "embedding", 20, CALLER.may_read()).select(F.col("query").alias("query_id"), "chunk_id", "rank")
    return retrieval.hybrid(lexical, near, "chunk_id", 10)


def discovered_sources(spark, folder):
    """Documents of the catalog that share words of their titles with the standing searches."""
    catalog = _docs(spark, folder).select(F.col("doc_id").alias("source_id"), "agent_id", T.tokens(F.coalesce("document_title", F.lit(""))).alias("terms"))
    return retrieval.discovered_sources(_searches(spark), catalog)


def query_parts(spark, folder):
    """Evaluation items as questions, two at a time, cut into typed parts."""
    q = table(spark, folder, "eval_items").where(F.col("text").isNotNull()).select(F.col("item_id").alias("query_id"), F.concat(F.lit("How many parts leaked; compare lot A-1 and lot B-2; "), F.col("item_id").cast("string"), F.lit("? why so")).alias("query_text")).distinct()
    return retrieval.decomposed(q)


def _found_chunks(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "parent_node_id", "chunk_type", "content_text", "metadata").distinct()
    return c, retrieval.bm25(c, "chunk_id", "content_text", _searches(spark), CALLER.may_read(), 10)


def parent_expansion(spark, folder):
    c, found = _found_chunks(spark, folder)
    return retrieval.siblings(found, c, CALLER.may_read())


def context_budget(spark, folder):
    c, found = _found_chunks(spark, folder)
    return retrieval.within_budget(found.join(c, "chunk_id"), "content_text", 4000).select("query_id", "chunk_id", "rank", "used_chars")


def evidence_checks(spark, folder):
    c, found = _found_chunks(spark, folder)
    return retrieval.evidence_summary(found.join(c, "chunk_id"))


def source_labels(spark, folder):
    c = table(spark, folder, "chunks").select("chunk_id", "chunk_type", "policy_version").distinct()
    return c.groupBy(retrieval.source_label(F.col("chunk_type"), F.coalesce(F.col("policy_version") == "canonical-chunks-v2", F.lit(False))).alias("label")).agg(F.count("*").alias("n"))


def intents(spark, folder):
    """Intents of the items' first words, of some of which only small talk or nothing is left."""
    e = table(spark, folder, "eval_items").select("item_id", F.when(F.col("item_id") % 5 == 0, "Thank you very much").when(F.col("item_id") % 5 == 1, F.substring(T.normalised("text"), 1, 2)).otherwise(F.col("text")).alias("q"))
    i = retrieval.default_intent("q")
    return e.select(i.alias("intent"), retrieval.route(i).alias("route")).groupBy("intent", "route").agg(F.count("*").alias("n"))


def last_turns(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    return retrieval.last_turns(e, 4, "user_id", "event_id")


# ---- structured path ----


def structured_aggregate(spark, folder):
    li = table(spark, folder, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_shipdate").alias("first_ship"), F.count("*").alias("n"))


def structured_filter(spark, folder):
    li = table(spark, folder, "lineitem")
    kept = li.where(F.col("l_quantity").between(10, 20) & (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.05))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


def structured_join(spark, folder):
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy(F.desc("total"), "n_name")


def structured_rollup(spark, folder):
    return table(spark, folder, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


def structured_page(spark, folder):
    return table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").offset(50).limit(50)


def guarded_statement(spark, folder):
    table(spark, folder, "part").createOrReplaceTempView("approved_part")
    return guarded_sql(spark, "WITH b AS (SELECT p_brand, p_size FROM approved_part WHERE p_size >= :least) SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM b GROUP BY p_brand", {"approved_part"}, 1000, {"least": 10}).result


# ---- workbooks ----


def _sheet(spark, folder):
    p = table(spark, folder, "part")
    return workbook.cleaned(workbook.long_cells(p.withColumn("sheet_id", F.col("p_brand")).withColumn("row", F.col("p_partkey").cast("int")), ["sheet_id", "row"], ["p_name", "p_type", "p_size", "p_retailprice"]))


def sheet_regions(spark, folder):
    return workbook.classified(_sheet(spark, folder)).select("sheet_id", "region_no", "first_row", "last_row", "cell_range", "classification", "populated", "numeric_ratio")


def sheet_classes(spark, folder):
    return workbook.sheet_class(workbook.classified(_sheet(spark, folder)))


def sheet_headers(spark, folder):
    return workbook.headers(_sheet(spark, folder))


def row_texts(spark, folder):
    cells = workbook.long_cells(table(spark, folder, "supplier"), ["s_suppkey"], ["s_name", "s_nationkey"])
    return workbook.row_texts(cells, ["s_suppkey"])


def sheet_rows(spark, folder):
    """The rows below each sheet region's header, by named column."""
    return workbook.table_rows(_sheet(spark, folder)).groupBy("sheet_id", "table_name", "column_name", "kind").agg(F.count("*").alias("n"))


def workbook_nodes(spark, folder):
    return workbook.tree("parts.xlsx", _sheet(spark, folder)).groupBy("node_type").agg(F.count("*").alias("n"), F.count_distinct("node_id").alias("n_ids"))


def cells_long(spark, folder):
    return _cells(spark, folder).groupBy("column_name", "kind").agg(F.count("*").alias("n"), F.min("value").alias("least"))


def column_names(spark, folder):
    d = _docs(spark, folder).select("doc_id", F.coalesce("lang", F.lit("none")).alias("sheet"), "document_title")
    return workbook.column_names(d, ["sheet"], "doc_id", "document_title").select("doc_id", "column_name")


def activity_islands(spark, folder):
    e = table(spark, folder, "events").select("event_type", F.floor(F.unix_timestamp("ts") / 60).alias("minute"))
    return blocks.islands(e, ["event_type"], "minute")


# ---- time windows ----


def hourly_events(spark, folder):
    return ingest.windowed_counts(table(spark, folder, "events"), "ts", "event_type", "value").withColumn("total", F.round("total", 4))


def event_sessions(spark, folder):
    return ingest.sessions(table(spark, folder, "events").select("user_id", "ts"), "user_id", "ts")


# ---- catalogs ----


def agent_collections(spark, folder):
    return table(spark, folder, "agents").select("agent_id", T.collection_name("agent_id").alias("collection"), "collection_name", T.is_safe_component("agent_id").alias("is_safe"))


def catalog_entries(spark, folder):
    """One row per table and column: what structured queries may use."""
    rows = [(name, field.name, field.dataType.simpleString(), at) for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem") for at, field in enumerate(table(spark, folder, name).schema, 1)]
    entries = spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")
    return enrich.field_policies(entries).select("table_name", "column_name", "position", "use", "answer_visible")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The passages that best answer the standing searches, for a caller of two groups, within a context budget."""
    c = table(spark, folder, "chunks").select("chunk_id", "document_id", "chunk_type", "content_text", "metadata").distinct()
    found = retrieval.bm25(c, "chunk_id", "content_text", _searches(spark), CALLER.may_read(), 10)
    return retrieval.within_budget(found.join(c.drop("metadata"), "chunk_id"), "content_text", 6000).select("query_id", "rank", "chunk_id", "document_id", "score", "used_chars")


_NAMES = (p3_found, p3_nodes, p3_tables, canonical_nodes, node_inspection, subtree_flags, node_references, canonical_branches, export_elements, missing_pages, text_normalised, token_counts, token_topk, technical_values, text_compared, headings_and_bullets, inferred_titles, lines_to_nodes, section_carry_forward, branch_nodes, markdown_sections, markdown_blocks, duplicate_content, multiset_difference, multiset_intersection, missing_tokens, coverage_by_document, phrase_matches, measurements, time_budgets, suspicious_numbers, page_base, page_text_fold, outcome_summary, table_compared, best_overlap, words_in_box, field_policy_cells, reference_registry, visual_assets, quality_issues, quality_status, artifact_chunks, artifact_manifests, chunk_problems, chunk_statistics, context_prefixes, latest_versions, resolved_sources, intact_artifacts, source_keys, vector_topk, vector_validity, vector_payload, unknown_vectors, embedded_offline, permitted_chunks, bm25_topk, rrf_fusion, hybrid_fusion, discovered_sources, query_parts, parent_expansion, context_budget, evidence_checks, source_labels, intents, last_turns, structured_aggregate, structured_filter, structured_join, structured_rollup, structured_page, guarded_statement, sheet_regions, sheet_classes, sheet_headers, row_texts, sheet_rows, workbook_nodes, cells_long, column_names, activity_islands, hourly_events, event_sessions, agent_collections, catalog_entries)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _NAMES}


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
