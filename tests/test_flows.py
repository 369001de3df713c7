import json

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import assembly, canonical, chunking, nested, pipeline, providers, quality, reconcile, retrieval, vectors, workbook
from lectern.sources import office
from tests.test_core import document, node, office_files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_budgets_and_numbers(spark):
    pages = spark.createDataFrame([(1,), (20,), (90,), (140,), (300,)], "p int")
    first = T.attempt_seconds(F.col("p"))
    assert [(r.f, r.r, r.w) for r in pages.select(first.alias("f"), T.retry_seconds(first).alias("r"), T.watchdog_seconds(first).alias("w")).collect()] == [(120, 300, 540), (180, 360, 660), (600, 900, 1620), (900, None, 1020), (900, None, 1020)]
    assert one(spark, T.retry_seconds(F.lit(600), F.lit(1500.5))) is None and T.checked_budgets()["most"] == 900
    with pytest.raises(ValueError):
        T.checked_budgets(least=1000)
    bad = {"dielectric 101122": True, "resistancelike 101122": False, "thermal 10¹² or 10555": False, "ohm 1055": False, "Volume 10 ^5, 10555": False, "surface x10555": False}
    assert {t: one(spark, quality.suspicious_number(F.lit(t))) for t in bad} == bad and one(spark, quality.suspicious_number(F.lit(None).cast("string"))) is False


def test_canonical_columns(spark):
    cells = [node("table_cell", f"c{i}", t) for i, t in enumerate(("Requirement(s): x", "y"))]
    doc = document(
        node("page", "p1", children=[node("paragraph", "a", "one two three four five six seven eight nine ten eleven twelve"), node("table", "t", children=[node("table_row", "r", "one two three four five six seven eight nine ten eleven twelve", children=cells)], requires_review=True)]) | {"provenance": {"page_number": "3"}},
        node("page", "p2", references=[{"reference_id": "x", "status": "ok"}, {"reference_id": "y"}]),
    )
    df = spark.createDataFrame([(1, json.dumps(doc), "k"), (1, json.dumps(doc), "k"), (2, None, "k"), (3, "[1", "k"), (4, json.dumps({"root_nodes": [{"node_id": "e"}]}), "k")], "artifact_id bigint, master_json string, ord string")
    found = canonical.nodes(df)
    one_doc = found.where("artifact_id = 1")
    assert one_doc.count() == 7 and {r.node_id for r in one_doc.where("blocked").collect()} == {"t", "r", "c0", "c1"}
    row = canonical.inspection(one_doc).first()
    assert (row.n_nodes, row.n_blocked, row.deepest, row.pages, row.tables) == (7, 4, 3, 2, 1)
    assert [(r.node_id, r.n_review) for r in canonical.subtree_flags(one_doc).orderBy("top_ord").collect()] == [("p1", 1), ("p2", 0)]
    assert {r.ord for r in canonical.duplicate_table_prose(one_doc).collect()} == {1}
    assert [r.ord for r in canonical.layout_tables(one_doc).collect()] == [2]
    assert [(r.reference_id, r.status) for r in canonical.node_references(found).orderBy("at").collect()] == [("x", "ok"), ("y", None)]
    assert canonical.subtree_text(one_doc).first().text.endswith("Requirement(s): x y")
    assert {(r.artifact_id, r.code) for r in canonical.empty_warnings(found, df).collect()} == {(2, "no_text"), (2, "no_structure"), (3, "no_text"), (3, "no_structure"), (4, "no_text"), (4, "no_structure")}
    expected = spark.createDataFrame([(1, 2, None, None, 5), (9, 1, None, None, None)], "artifact_id bigint, pages int, slides int, sheets int, tables int")
    checks = canonical.structure_check(canonical.inspection(found), expected)
    assert {(r.artifact_id, r.kind, r.matches) for r in checks.collect()} == {(1, "pages", True), (1, "tables", False), (9, "pages", False)}
    share = spark.createDataFrame([(1, 0.95), (4, 0.99)], "artifact_id bigint, share double")
    assert {(r.artifact_id, r.status) for r in canonical.corpus_status(checks, share, spark.createDataFrame([], "artifact_id bigint, n int")).collect()} == {(1, "review_required"), (4, "passed"), (9, "review_required")}
    assert canonical.nodes(df.limit(0)).count() == 0
    assert "one two" in pipeline.canonical_text(df).where("artifact_id = 1").first().text


def test_merging_extractions(spark):
    pages = spark.createDataFrame([("d", 3), ("e", None), ("f", 0)], "doc string, page_count int")
    found = spark.createDataFrame([("d", 1), ("d", 1), ("d", 3), ("x", 9)], "doc string, page_no int")
    assert [(r.doc, r.page_no) for r in reconcile.missing_pages(pages, found, ["doc"]).collect()] == [("d", 2)]
    other = spark.createDataFrame([("d", 1), ("d", 3), ("x", 8)], "doc string, page_no int")
    assert {(r.doc, r.route) for r in reconcile.same_page_set(found, other, ["doc"]).collect()} == {("d", "merge"), ("x", "native")}
    box = "s int, {} string, name string, left double, top double, width double, height double"
    images = spark.createDataFrame([(1, "i1", "Pic 1", 1.2, 2.0, 3.0, 4.0), (1, "i2", "gone", 1.9, 2.0, 3.0, 4.0), (1, "i3", None, 9.0, 9.0, 9.0, 9.0)], box.format("image_id"))
    pictures = spark.createDataFrame([(1, "a", "other", 1.0, 2.0, 3.0, 4.0), (1, "b", " Pic  1", 1.0, 2.0, 3.0, 4.0)], box.format("picture_id"))
    assert {(r.image_id, r.picture_id) for r in reconcile.matched_images(images, pictures, ["s"]).collect()} == {("i1", "b"), ("i2", "a"), ("i3", None)}
    decisions = spark.createDataFrame([("d", 1, "conflict", "torque 5 Nm", "torque 7 Nm", 1), ("d", 2, "duplicate", "a", "a", 1), ("d", 3, "conflict", "torque 5 Nm", "torque 9 Nm", 2)], "doc string, block_no int, decision string, base_text string, block_text string, box_id int")
    regions = spark.createDataFrame([("d", 1, "the torque 7 Nm here")], "doc string, box_id int, region_text string")
    assert [(r.decision, r.winner) for r in reconcile.arbitrated(decisions, regions, ["doc"]).orderBy("block_no").collect()] == [("conflict_resolved", "B"), ("duplicate", None), ("conflict", None)]
    assert one(spark, reconcile.pdf_route(F.lit(True), F.lit(False), F.lit(None).cast("boolean"))) == "fallback" and one(spark, reconcile.pdf_route(F.lit(True), F.lit(False), F.lit(True))) == "layout"
    assert one(spark, reconcile.page_text(F.lit(" "), F.array(F.lit(" a "), F.lit(""), F.lit("b")))) == "a\nb"
    media = spark.createDataFrame([("d", "m2", 2), ("d", "m1", 1)], "doc string, medium string, m_ord int")
    assert {(r.image_id, r.medium) for r in reconcile.zipped_media(images.withColumn("doc", F.lit("d")).select("doc", "image_id"), media, ["doc"], "image_id", "m_ord").collect()} == {("i1", "m1"), ("i2", "m2"), ("i3", None)}


def test_exports_and_matrices(spark):
    tree = {"body": {"self_ref": "#/body", "children": [{"self_ref": "#/t/0", "label": "section_header", "text": " ", "content": "Head", "prov": [{"page_no": 2, "bbox": {"l": 9.0, "t": 5.0, "r": 3.0}}, {"page_no": 3}]}, {"self_ref": "#/t/1", "label": "text", "text": "x", "prov": {"page_no": 0}}, {"self_ref": "#/t/0", "label": "again"}]}}
    df = spark.createDataFrame([(1, json.dumps(tree)), (1, json.dumps(tree)), (2, None)], "extraction_id bigint, exported string")
    found = assembly.export_elements(nested.emit_tagged(df, "extraction_id", "exported", "exported", "self_ref"))
    got = {r.ord: (r.self_ref, r.text, r.page_no, r.left) for r in found.collect()}
    assert sorted(got.values(), key=str) == sorted([("#/body", None, None, None), ("#/t/0", "Head", 2, 3.0), ("#/t/1", "x", None, None), ("#/t/0", None, None, None)], key=str)
    assert [r.self_ref for r in assembly.resolved_references(found).orderBy("place").collect()] == ["#/body", "#/t/0", "#/t/1"]
    page = assembly.export_pages(found).first()
    assert (page.page_no, page.n_blocks, page.text) == (2, 1, "Head")
    forms = {'[["a","b"],["1",null]]': [["a", "b"], ["1", ""]], '[{"a": 1, "b": "x"}, {"b": 2}]': [["a", "b"], ["1", "x"], ["", "2"]], '{"a": 1}': None, "[]": None, "broken": None}
    for text, wanted in forms.items():
        assert one(spark, assembly.matrix(F.lit(text))) == wanted
    tables = spark.createDataFrame([("t", [["Name", ""], ["bolt", " 5 "], ["", " "]]), ("n", None)], "k string, m array<array<string>>")
    assert sorted((r.node_type, r.row, r.text) for r in assembly.matrix_nodes(tables, "k", "m").collect()) == [("table_cell", 1, "5"), ("table_cell", 1, "bolt"), ("table_header", 0, "Name | "), ("table_row", 1, "Name: bolt | column_2: 5")]
    cells = spark.createDataFrame([("t", 0, 1, "B", True), ("t", 0, 0, "A", True), ("t", 1, 0, None, None)], "k string, row int, col int, text string, column_header boolean")
    assert [(r.row, r.text, r.is_header) for r in assembly.structured_cell_nodes(cells, "k").orderBy("row").collect()] == [(0, "A | B", True), (1, "", False)]


def test_ingest_persist_and_index(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, body in office_files().items():
        (source / name).write_bytes(body)
    files = office.read_files(spark, str(source)).select("path", "content")
    nodes, issues = pipeline.ingest(files, "brake-agent")
    types = {(r.path.rpartition("/")[2], r.node_type) for r in nodes.collect()}
    assert {("a.xlsx", "sheet"), ("a.xlsx", "table_cell"), ("b.docx", "title_block"), ("c.pptx", "slide"), ("c.pptx", "note_block")} <= types
    assert {r.record_id.rpartition("/")[2] for r in issues.where("code in ('unsupported', 'BadZipFile')").collect()} == {"e.pdf", "f.docx"}
    assert pipeline.branched(nodes).where("branch = 'sql'").count() > 0
    none = spark.createDataFrame([], "document_id string, source_version string, source_hash string, processing_key string, artifact_status string, created_at timestamp")
    store = str(tmp_path / "canonical")
    first = pipeline.ingest_and_persist(files.where("path like '%.docx' or path like '%.html'"), none, "brake-agent", "p1", store)
    manifests = spark.createDataFrame(first.collect(), none.schema)
    assert {(r.source_version, r.artifact_status) for r in manifests.collect()} == {("v1", "validated")} and spark.read.parquet(store).count() == 2
    again = pipeline.resolved_files(files, manifests, "brake-agent", "p1")
    assert {(r.path.rpartition("/")[2], r.action) for r in again.where("path like '%b.docx' or path like '%d.html' or path like '%g.txt'").collect()} == {("b.docx", "reuse"), ("d.html", "reuse"), ("g.txt", "create")}
    doc = document(node("section", "s", children=[node("paragraph", "p", "Torque is 5 Nm.")])) | {"agent_id": "brake-agent", "security_scope": {"allowed_groups": ["g"]}}
    artifacts = spark.createDataFrame([(1, json.dumps(doc)), (2, json.dumps(document(node("paragraph", "q", "Bad."), errors=["e"])))], "artifact_id bigint, master_json string")
    points = pipeline.index(artifacts, vectors.hashed_provider(8), "m", 8)
    row = points.collect()
    assert len(row) == 1 and row[0].collection == "documents-brake-agent-chunks" and row[0].allowed_groups == ["g"]
    assert points.where(retrieval.Caller(("g",)).may_read_payload()).count() == 1 and points.where(retrieval.Caller(("h",)).may_read_payload()).count() == 0
    chunks, policy, folder = chunking.chunk_artifacts(artifacts), chunking.Policy(), str(tmp_path / "chunks")
    assert pipeline.persist_chunks(chunks, policy, folder) == 1 and pipeline.persist_chunks(chunks, policy, folder) == 0
    assert pipeline.verified_chunks(spark, folder).count() == 1
    embedded = vectors.embed(chunks.where("kind = 'chunk'"), vectors.hashed_provider(8), "m", 8)
    assert json.loads(vectors.with_lineage(embedded, chunks.where("kind = 'chunk'")).first().metadata)["parent_node_id"] == "s"
    with pytest.raises(Exception, match="unknown chunk"):
        vectors.checked_points(chunks.where("chunk_id = 'none'"), embedded).collect()
    assert vectors.ensure_collection(str(tmp_path), spark, "c", 8) == vectors.ensure_collection(str(tmp_path), spark, "c", 8)
    with pytest.raises(ValueError):
        vectors.ensure_collection(str(tmp_path), spark, "c", 9)
    images = spark.createDataFrame([(bytearray(b"x"), "png"), (bytearray(b"x"), "jpg"), (None, "png")], "content binary, extension string")
    assert [r.n for r in pipeline.image_files(images, str(tmp_path / "img")).collect()] == [2] and pipeline.image_files(images, str(tmp_path / "img")).count() == 0
    report = pipeline.corpus_report(files.selectExpr("path", "'f' as source_type"), files.limit(2).selectExpr("path", "'passed' as status"))
    assert (report.first().n_files, report.first().n_passed, report.first().n_failed) == (7, 2, 5)


def test_query_side(spark):
    q = spark.createDataFrame([("a", "hello there"), ("b", "what about it?"), ("c", "torque of the rail"), ("d", None), ("e", "football scores"), ("f", "Thank you, torque?")], "id string, q string")
    terms = F.array(F.lit("torque"), F.lit("rail"))
    assert {r.id: (r.i, r.t) for r in q.select("id", retrieval.default_intent("q", terms).alias("i"), retrieval.route(retrieval.default_intent("q", terms)).alias("t")).collect()} == {"a": ("general_chat", "canned_reply"), "b": ("clarification_qn", "clarify"), "c": ("Domain_qn", "retrieve"), "d": ("Domain_qn", "retrieve"), "e": ("out_of_scope", "decline"), "f": ("Domain_qn", "retrieve")}
    state = one(spark, retrieval.state_of(retrieval.parsed_intent(F.lit('{"intent": "clarification_qn", "clarification_question": "Which rail?"}'), F.lit("it"))))
    assert (state.needs_clarification, state.ask_user, state.answer, state.resolved_query) == (True, "Which rail?", None, None)
    assert one(spark, retrieval.parsed_intent(F.lit('{"intent": "other"}'), F.lit("q"))).intent == "Domain_qn"
    docs = spark.createDataFrame([("1", "red bolt", '{"security_scope": {"allowed_groups": ["g"]}}'), ("2", "red bolt bolt", '{"security_scope": {"allowed_users": ["me"]}}'), ("3", "red bolt", None)], "chunk_id string, body string, metadata string")
    ask = spark.createDataFrame([("q", "bolt")], "query_id string, query_text string")
    found = lambda caller: {r.chunk_id for r in retrieval.bm25(docs, "chunk_id", "body", ask, caller.may_read()).collect()}
    assert (found(retrieval.Caller(("g",))), found(retrieval.Caller((), "me")), found(retrieval.Caller())) == ({"1"}, {"2"}, set())
    table = spark.createDataFrame([("1", [1.0, 0.0], ["g"]), ("2", [1.0, 0.1], ["h"])], "id string, v array<float>, allowed_groups array<string>").withColumn("allowed_users", F.lit(None).cast("array<string>"))
    near = vectors.top_k(table, spark.createDataFrame([("q", [1.0, 0.0])], "id string, v array<float>"), "id", "v", 5, retrieval.Caller(("g",)).may_read_payload())
    assert [r.id for r in near.collect()] == ["1"]
    lists = spark.createDataFrame([("q", "a", 1), ("q", "b", 2)], "query_id string, chunk_id string, rank int")
    turned = retrieval.hybrid(lists, lists.where("rank = 2"), "chunk_id", rerank=lambda d: d.withColumn("rank", -F.col("rank")))
    assert {(r.chunk_id, r["rank"]) for r in turned.collect()} == {("b", -1), ("a", -2)}
    deeper = retrieval.corrected_search(lambda d, k: d.crossJoin(spark.range(k // 10).withColumnRenamed("id", "rank")).select("query_id", "rank"), ask, rounds=2, need=2)
    assert {(r["rank"], r["round"]) for r in deeper.collect()} == {(0, 1), (1, 1)}
    shown = retrieval.projected(lists, spark.createDataFrame([("rank", False), ("x", False)], "column_name string, answer_visible boolean"))
    assert shown.columns == ["query_id", "chunk_id"]
    passages = spark.createDataFrame([("q", "a", "p", "torque 5", 3.0), ("q", "b", "p", "torque 7", 2.0), ("q", "c", "r", None, 1.0), ("z", "d", "p", "torque 5", 0.5)], "query_id string, chunk_id string, parent_node_id string, content_text string, score double")
    assert {(r.query_id, r.confidence, r.is_sufficient, r.is_confident, r.has_conflict) for r in retrieval.evidence_summary(passages).collect()} == {("q", 0.75, True, True, True), ("z", 0.333333, False, False, False)}
    given = spark.sql("SELECT 'q' AS query_id, 'u' AS user_id, -1 AS rating, 'no' AS comment, 0.9D AS confidence, TIMESTAMP'2024-01-01 00:00:00' AS created_at UNION ALL SELECT 'q', 'v', 1, NULL, 0.8D, TIMESTAMP'2024-01-01 00:00:00'")
    assert {(r.user_id, r.escalated, str(r.due_at)) for r in retrieval.feedback_rows(given).collect()} == {("u", True, "2024-01-01 00:15:00"), ("v", False, "None")}


def test_providers_and_sheets(spark):
    images = spark.createDataFrame([("a", "pptx", bytearray(b"1")), ("b", "docx", bytearray(b"1")), ("c", "xlsx", None), ("d", "pptx", bytearray(b"!"))], "image_id string, source_type string, content binary")

    def recogniser(content):
        if content == b"!":
            raise OSError
        return [("Seen", 0.9), ("doubt", 0.2)]

    assert {(r.image_id, r.ocr_status, r.ocr_text) for r in providers.recognised(images, recogniser).collect()} == {("a", "ok", "Seen"), ("b", "skipped", None), ("c", "missing", None), ("d", "failed", None)}
    assert {r.ocr_status for r in providers.recognised(images).collect()} == {"off"}
    told = images.select("image_id", "content", F.lit("jpg").alias("extension"), providers.description_context(F.lit("T"), F.lit(None).cast("string"), F.lit("n " * 2000)).alias("context"))
    assert {(r.image_id, r.description_status) for r in providers.described(told, lambda url, context: f"{url[:15]} {len(context)}").collect()} == {("a", "ok"), ("b", "ok"), ("c", "skipped"), ("d", "ok")}
    rows = [("s", 1, 1, "Part", "string"), ("s", 1, 2, "Load mm", "string"), ("s", 2, 1, "bolt", "string"), ("s", 2, 2, "5", "integer"), ("s", 3, 1, "#REF!", "string"), ("s", 3, 2, "=A1", "string")]
    cells = spark.createDataFrame(rows, "sheet_id string, row int, col int, value string, kind string")
    data = workbook.table_rows(cells)
    assert {(r.row, r.column_name, r.value, r.unit) for r in data.collect()} == {(2, "part", "bolt", None), (2, "load_mm", "5", "mm"), (3, "part", "#REF!", None), (3, "load_mm", "=A1", "mm")}
    assert {r.node_type: r["count"] for r in workbook.tree("w", cells).groupBy("node_type").count().collect()} == {"workbook": 1, "sheet": 1, "region": 1, "table": 1, "table_row": 2, "table_cell": 4}
    assert {(r.code, r.n) for r in workbook.warnings(cells).collect()} == {("formula_errors", 1), ("formulas", 1)}
    sheets = spark.createDataFrame([("s",), ("empty",)], "sheet_id string")
    assert {(r.sheet_id, r.used_range) for r in workbook.used_range(cells, sheets).collect()} == {("s", "A1:B3"), ("empty", None)}
    assert {(r.sheet_id, r.classification) for r in workbook.sheet_classes(workbook.classified(cells), sheets).collect()} >= {("empty", "UNKNOWN")}
    pics = spark.createDataFrame([("s", "i", 1, 0, 2, 1), ("s", "j", 40, 2, None, None)], "sheet_id string, image_id string, row int, col int, last_row int, last_col int")
    assert {(r.image_id, r.cell_range, r.confidence) for r in workbook.image_nodes(pics, cells).collect()} == {("i", "A2:B3", 0.82), ("j", "C41:C41", 0.68)}
    assert {r.column_name for r in pipeline.branch_tables(data).collect()} == {"part", "load_mm"}


def test_jobs(spark, tmp_path):
    from lectern import jobs

    doc = document(node("section", "s", children=[node("paragraph", "p", "Torque is 5 Nm.")])) | {"agent_id": "brake-agent", "security_scope": {"allowed_groups": ["g"]}}
    artifacts, files = str(tmp_path / "artifacts"), tmp_path / "in"
    spark.createDataFrame([(1, json.dumps(doc))], "artifact_id bigint, master_json string").write.parquet(artifacts)
    files.mkdir()
    (files / "a.txt").write_bytes(b"one\n\ntwo")
    jobs.main(["chunks", "--artifacts", artifacts, "--store", str(tmp_path / "chunks")], spark)
    jobs.main(["index", "--artifacts", artifacts, "--store", str(tmp_path / "index"), "--dimensions", "8"], spark)
    assert spark.read.parquet(str(tmp_path / "chunks")).count() == 1 and spark.read.parquet(str(tmp_path / "index")).count() == 1
    for _ in range(2):  # the second run finds nothing new
        jobs.main(["ingest", "--files", str(files), "--agent", "brake-agent", "--key", "k", "--store", str(tmp_path / "store"), "--manifests", str(tmp_path / "manifests")], spark)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1 and spark.read.parquet(str(tmp_path / "manifests")).count() == 1
    listing = str(tmp_path / "listing")
    spark.createDataFrame([("a", "txt", "passed")], "path string, source_type string, status string").write.parquet(listing)
    jobs.main(["report", "--inventory", listing, "--results", listing, "--store", str(tmp_path / "report")], spark)
    assert spark.read.json(str(tmp_path / "report")).first().n_passed == 1
    with pytest.raises(SystemExit):
        jobs.main(["unknown"], spark)
