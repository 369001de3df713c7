import datetime
import io
import json
import uuid
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lectern.functions import compare
from lectern.functions import text as T
from lectern.operators import blocks, chunking, enrich, quality, reconcile, registry, retrieval, vectors, workbook
from lectern.plans.guard import Refused, guarded_sql, refused_row, write_log
from lectern.sources import agents, office
from lectern.streaming import ingest


def one(spark, column, **values):
    row = spark.createDataFrame([Row(**values)]) if values else spark.range(1)
    return row.select(column.alias("v")).first().v


def test_text_rules(spark):
    assert one(spark, T.normalised("x"), x=" a\u00a0\t b\u3000 ") == "a b"
    assert one(spark, T.normalised(F.lit(" \n "))) is None
    assert [one(spark, T.column_letters(F.lit(n))) for n in (1, 26, 27, 52, 702, 703, 16384)] == ["A", "Z", "AA", "AZ", "ZZ", "AAA", "XFD"]
    assert one(spark, T.cell_range(F.lit(1), F.lit(1), F.lit(9), F.lit(28))) == "A1:AB9"
    assert one(spark, T.column_name(F.lit("  Größe (mm) / x "))) == "größe_mm_x" and one(spark, T.column_name(F.lit("--"))) == "column"
    assert [one(spark, T.value_type(F.lit(v))) for v in ("true", "12", "-1.5", "", "x1")] == ["boolean", "integer", "float", "empty", "string"]
    assert [one(spark, T.bullet_text(F.lit(v))) for v in ("operating pressure", "-20 C", "- operating pressure", "-")] == ["operating pressure", "-20 C", "operating pressure", None]
    assert one(spark, T.is_heading(F.lit("Limits:"))) and one(spark, T.is_heading(F.lit("ABC DEF"))) and not one(spark, T.is_heading(F.lit("a plain line of text")))
    assert one(spark, T.uuid5(F.lit("chk_1"))) == str(uuid.uuid5(uuid.NAMESPACE_URL, "chk_1"))
    assert one(spark, T.attempt_seconds(F.lit(10))) == 120 and one(spark, T.attempt_seconds(F.lit(30))) == 240 and one(spark, T.attempt_seconds(F.lit(100), True)) == 900
    assert one(spark, T.measurement(F.lit("15 cm"))).asDict() == {"value": 15.0, "unit": "cm"}
    r = one(spark, T.reference_of(F.lit("HTTPS://User@Docs.Example:80/A/b.PDF;v=1?q=1#frag).")))
    assert (r.kind, r.uri, r.host, r.extension) == ("url", "https://user@docs.example:80/A/b.PDF?q=1", "docs.example", ".pdf")
    assert one(spark, T.reference_of(F.lit("\\\\srv\\share\\x.pptx"))).kind == "file" and one(spark, T.reference_of(F.lit("C:\\a.txt"))).uri == "file:///C:/a.txt"
    assert one(spark, T.without_fence(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'


PAIRS = [("Maximum operating temperature: 90 C", "maximum  operating temperature: 90 c", "duplicate"), ("The maximum operating temperature is 90 C for the sensor.", "Maximum operating temperature 90 C sensor", "near_duplicate"), ("The maximum operating temperature is 90 C for it", "The maximum operating temperature is 80 C for it", "conflict"), ("years 1879, 1958, 1963, 2020", "years 1879, 1958", "near_duplicate"), ("short", "an unrelated longer block of text", "fallback_only"), ("", "x", "fallback_only"), ("x", " ", "empty"), (None, None, "empty")]


def test_comparison_ladder(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in PAIRS], "a string, b string")
    assert [r.d for r in df.select(compare.compared("a", "b").alias("d")).collect()] == [d for *_, d in PAIRS]
    assert [compare.decision(a, b) for a, b, _ in PAIRS] == [d for *_, d in PAIRS]


def test_pages_tables_boxes(spark):
    page = "doc string, page int, chars bigint, score bigint, n_tables bigint"
    a = spark.createDataFrame([("d", 1, 100, 140, 0), ("d", 2, 10, 50, 0), ("d", 3, 5, 5, 1)], page)
    b = spark.createDataFrame([("d", 1, 101, 141, 0), ("d", 2, 200, 240, 0), ("d", 4, 1, 1, 0)], page)
    assert {r.page: r.base for r in reconcile.pair_pages(a, b, ["doc", "page"]).collect()} == {1: "fallback", 2: "fallback", 3: "docling", 4: "fallback"}
    cell = "t int, row int, col int, text string"
    x = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, 1, "1"), (2, 0, 0, "a"), (3, 0, 0, "a")], cell)
    y = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, 1, "2"), (2, 0, 0, " a"), (3, 0, 1, "b"), (4, 0, 0, "q")], cell)
    assert {r.t: r.decision for r in reconcile.compare_cells(x, y, ["t"]).collect()} == {1: "conflict", 2: "duplicate", 3: "fallback_only", 4: "fallback_only"}
    assert one(spark, reconcile.winner(F.lit("limit 1980 is 80 C"), F.lit("90"), F.lit("80"))) == "B" and one(spark, reconcile.winner(F.lit("in 1980"), F.lit("80"), F.lit("90"))) is None
    fold = spark.createDataFrame([("d", 1, "A B C D E", 1, "C"), ("d", 1, "A B C D E", 2, "new words come in here"), ("d", 1, "A B C D E", 3, "new words come in here")], "doc string, page int, base_text string, block_no int, block_text string")
    assert [r.accepted for r in reconcile.merge_page_text(fold, ["doc", "page"]).orderBy("block_no").collect()] == [False, True, False]
    image = "p int, image_id int, left double, top double, width double, height double, locator string"
    old = spark.createDataFrame([(1, 1, 0.0, 0.0, 5.0, 5.0, None)], image)
    new = spark.createDataFrame([(1, 1, 0.0, 0.0, 5.0, 5.0, "x"), (1, 2, None, None, None, None, "pic"), (1, 3, None, None, None, None, " pic")], image)
    assert [r.image_id for r in reconcile.new_images(old, new, ["p"]).collect()] == [2]


def test_blocks(spark):
    df = spark.createDataFrame([(1, "TITLE ONE\r\nfirst line\nsecond line\n- point\n\n-\nlast"), (2, None), (3, " ")], "k int, body string")
    got = [(r.node_no, r.node_type, r.text) for r in blocks.lines_to_nodes(df, "k", "body").orderBy("k", "node_no").collect()]
    assert got == [(0, "title_block", "TITLE ONE"), (1, "paragraph", "first line second line"), (2, "bullet_block", "point"), (3, "paragraph", "last")]
    assert {r.section_title for r in blocks.with_sections(blocks.lines_to_nodes(df, "k", "body"), "k").collect()} == {"TITLE ONE"}
    assert [(r.first, r.last, r.n) for r in blocks.islands(spark.createDataFrame([(1, 3), (1, 4), (1, 4), (1, 9)], "g int, p int"), ["g"], "p").orderBy("first").collect()] == [(3, 4, 2), (9, 9, 1)]


def test_governance(spark):
    uses = {n: one(spark, enrich.field_use(F.lit(n))) for n in ("Component", "Internal Owner", "Reference Link", "internal_note", "", "user_email")}
    assert uses == {"Component": "standard", "Internal Owner": "internal_only", "Reference Link": "reference_link", "internal_note": "internal_only", "": "standard", "user_email": "internal_only"}
    assert one(spark, enrich.field_use(F.lit("internal_note"), strict=False)) == "standard"
    nodes = spark.createDataFrame([("n", "see https://a.example/x.pdf, and https://b.example", None, "standard"), ("m", None, "\\\\srv\\x.ppt", "reference_link"), ("o", None, "no reference", "reference_link")], "node_id string, text string, value string, use string")
    got = {(r.node_id, r.status, r.answer_eligible) for r in enrich.references(nodes, spark.createDataFrame([("B.example",)], "host string")).collect()}
    assert got == {("n", "unverified_remote", False), ("n", "trusted_remote", True), ("m", "unverified_network_path", False), ("o", "invalid", False)}


def test_quality(spark):
    schema = "record_id int, ord int, node_id string, parent_id string, document_id string, node_document_id string, node_type string, text string, confidence double, n_children int, requires_review boolean, conflict boolean, structured boolean, has_header boolean, has_rows boolean"
    rows = [(1, 1, "p", None, "d", "d", "page", None, 1.0, 0, None, None, None, None, None), (1, 2, "a", "p", "d", "d", "paragraph", "Same", 0.4, 0, None, None, None, None, None), (1, 3, "a", "p", "d", "x", "paragraph", " same ", None, 0, None, True, None, None, None), (1, 4, "t", "p", "d", "d", "table", None, 1.0, 1, True, None, None, True, None), (2, 1, "q", None, "d", "d", "paragraph", None, 1.0, 0, None, None, None, None, None)]
    got = sorted((r.record_id, r.node_id or "", r.code) for r in quality.issues(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([(1, "p", "empty_container"), (1, "a", "low_confidence"), (1, "a", "duplicate_node_id"), (1, "a", "provenance_document_mismatch"), (1, "a", "duplicate_content"), (1, "a", "extraction_conflict"), (1, "t", "unreadable_table"), (1, "t", "incomplete_table"), (2, "", "no_extracted_content")])
    assert one(spark, quality.suspicious_number(F.lit("Volume Resistivity 101122"))) and not one(spark, quality.suspicious_number(F.lit("Volume Resistivity 10^12 or 101122")))


def node(kind, name, text=None, children=(), **attributes):
    return {"node_id": name, "node_type": kind, "text": text, "children": list(children), "attributes": attributes}


def document(*roots, errors=()):
    return {"document_id": "d", "version": "v1", "agent_id": "a", "source_type": "pdf", "metadata": {"title": "T"}, "root_nodes": list(roots), "quality": {"errors": list(errors)}}


def chunked(spark, doc, policy=chunking.Policy()):
    rows = chunking.chunk_artifacts(spark.createDataFrame([(1, json.dumps(doc))], "artifact_id bigint, master_json string"), policy).collect()
    return [sorted((r for r in rows if r.kind == k), key=lambda r: (r.parent_node_id or "", r.part_no or 0)) for k in ("chunk", "rejection")]


def test_chunk_building(spark):
    section = node("section", "s1", children=[node("paragraph", "p1", "One.", references=[{"reference_id": "r", "answer_eligible": True}]), node("paragraph", "p2", "Two.", references=[{"reference_id": "r", "answer_eligible": False}])])
    doc = document(section) | {"security_scope": {"classification": "internal", "allowed_groups": ["g"]}, "source_hash": "h"}
    chunks, rejected = chunked(spark, doc)
    assert len(chunks) == 1 and chunks[0].source_node_ids == ["p1", "p2"] and chunks[0].parent_node_id == "s1" and not rejected
    more = json.loads(chunks[0].metadata)
    assert more["security_scope"]["allowed_groups"] == ["g"] and more["source_hash"] == "h" and more["breadcrumbs"] == ["T"] and more["references"] == [{"reference_id": "r", "answer_eligible": "false"}] and more["answer_eligible_references"] == []
    assert [c.chunk_id for c in chunked(spark, doc)[0]] == [chunks[0].chunk_id]
    chunks, rejected = chunked(spark, document(section, errors=["x"]))
    assert not chunks and [(r.reason, r.severity) for r in rejected] == [("Document has blocking errors.", "error")]
    assert len(chunked(spark, document(section, errors=["x"]), chunking.Policy(strict=False))[0]) == 1
    long = node("section", "s1", children=[node("paragraph", "p1", "x" * 70), node("paragraph", "p2", "y" * 70)])
    assert [c.overlap_node_ids for c in chunked(spark, document(long), chunking.Policy(max_chunk=150, max_overlap=80))[0]] == [[], ["p1"]]
    two = [node("section", s, children=[node("paragraph", "p" + s, "Text.")]) for s in ("s1", "s2")]
    assert [c.parent_node_id for c in chunked(spark, document(*two))[0]] == ["s1", "s2"]
    blocked = node("section", "s", children=[node("paragraph", "p", "Hidden."), node("paragraph", "q", "Shown.", reconciliation=[{"decision": "conflict"}]), node("paragraph", "r", "Shown.")])
    blocked["children"][0]["attributes"]["retrieval_allowed"] = False
    assert [c.source_node_ids for c in chunked(spark, document(blocked))[0]] == [["r"]]


def test_table_chunks(spark):
    cells = [node("table_cell", "c1", "ASA"), node("table_cell", "c2", "90 C"), node("table_cell", "c3", "secret", field_policy={"retrieval_allowed": False})]
    row = node("table_row", "r1", children=cells, row_index=4) | {"provenance": {"page_number": 7}}
    table = node("table", "t", children=[node("table_header", "h", header_rows=[["Material", "Temperature", "Note"], ["", "peak"]]), row, node("table_row", "r2", children=cells, retrieval_allowed=False), node("table_row", "r3", semantic_text="plain  row")])
    chunks, _ = chunked(spark, document(table))
    assert {c.content_text for c in chunks} == {"Material: ASA | Temperature / peak: 90 C", "plain row"} and chunks[0].chunk_type == "table_row"
    more = json.loads(next(c.metadata for c in chunks if "ASA" in c.content_text))
    assert (more["page_number"], more["row_index"], more["header_context"], more["field_policies"]) == ("7", "4", ["Material | Temperature | Note", " | peak"], [{"retrieval_allowed": "false"}])
    table["attributes"]["requires_review"] = True
    assert [r.parent_node_id for r in chunked(spark, document(table))[1]] == ["t"]


def test_piece_spans_and_windows():
    text = " ".join(["A b."] * 40)
    assert [text[a:b] for a, b in chunking.piece_spans(text, 30)][0] == "A b. A b. A b. A b. A b. A b." and all(b - a <= 10 for a, b in chunking.piece_spans("x" * 35, 10))
    assert chunking.piece_spans("", 5) == [] and chunking.windows([], 9, 3) == [] and chunking.windows([50, 1], 9, 3) == [(0, 1, 0), (1, 2, 0)]
    assert chunking.windows([3, 3, 3, 3], 8, 3) == [(0, 2, 0), (1, 3, 1), (2, 4, 1)]


def test_chunks_of_stored_records(spark):
    good = json.dumps(document(node("paragraph", "p", "Text.")))
    df = spark.createDataFrame([(1, good, "c"), (1, good, "c"), (2, None, "c"), (3, "{cut", "c"), (None, good, "c")], "artifact_id bigint, master_json string, chunk_id string")
    made = chunking.chunk_artifacts(df)
    assert {(r.artifact_id, r.chunk_count, r.status) for r in chunking.manifests(made).collect()} == {(1, 1, "ready_for_embedding"), (2, 0, "needs_review"), (3, 0, "needs_review")}
    assert chunking.chunk_artifacts(df.limit(0)).count() == 0


def test_registry(spark):
    day = lambda n: datetime.datetime(2024, 1, n)
    m = spark.createDataFrame([("s", "v9", "h9", "p", "ready", day(1)), ("s", "v10", "h10", "p", "ready", day(2)), ("r", "v1", "h", "p", "requires_review", day(1))], "source string, source_version string, source_hash string, processing_key string, artifact_status string, created_at timestamp")
    assert {(r.source, r.source_version) for r in registry.latest_versions(m, ["source"]).collect()} == {("s", "v10"), ("r", "v1")}
    incoming = spark.createDataFrame([("s", "h10", "p"), ("s", "h9", "p"), ("s", "h10", "other"), ("r", "h", "p"), ("new", "h", "p")], "source string, source_hash string, processing_key string")
    got = sorted((r.source, r.source_hash, r.processing_key, r.action, r.version) for r in registry.resolve(incoming, m, ["source"]).collect())
    assert got == sorted([("s", "h10", "p", "reuse", "v10"), ("s", "h9", "p", "create", "v11"), ("s", "h10", "other", "create", "v11"), ("r", "h", "p", "create", "v2"), ("new", "h", "p", "create", "v1")])
    rows = spark.createDataFrame([("d1", "v1", "body"), ("d1", "v1", "body"), ("d2", "v1", "x")], "doc string, version string, body string")
    first = registry.publish(rows, None, ["doc", "version"], "body")
    assert first.count() == 2 and registry.publish(rows, first, ["doc", "version"], "body").count() == 0
    for bad in (("d1", "v1", "changed"), ("../up", "v1", "x")):
        with pytest.raises(Exception, match="stored content differs|unsafe doc"):
            registry.publish(spark.createDataFrame([bad], rows.schema), first, ["doc", "version"], "body").collect()
    with pytest.raises(Exception, match="two contents"):
        registry.publish(spark.createDataFrame([("d9", "v1", "a"), ("d9", "v1", "b")], rows.schema), None, ["doc", "version"], "body").collect()


def test_vectors(spark):
    calls = []

    def provider(texts):
        calls.append(len(texts))
        if len(calls) == 1:
            raise OSError("down")
        return [[float(len(t))] * 3 for t in texts]

    tried = vectors.with_retries(provider, sleep=lambda s: None)
    assert tried(["a", "bb"]) == [[1.0] * 3, [2.0] * 3] and calls == [2, 2]
    chunks = spark.createDataFrame([("a", "text one"), ("b", "  "), ("c", None), ("d", "more")], "chunk_id string, embedding_text string")
    assert {r.chunk_id for r in vectors.embed(chunks, vectors.hashed_provider(8), "m", 8).collect()} == {"a", "d"}
    with pytest.raises(Exception, match="other vectors"):
        vectors.embed(chunks, vectors.hashed_provider(8), "m", 9).collect()
    table = spark.createDataFrame([(i, [float(i == 0), float(i % 3), 1.0]) for i in range(9)] + [(99, None)], "vec_id bigint, embedding array<float>")
    got = vectors.top_k(table, table.where("vec_id = 0"), "vec_id", "embedding", 3, retrieval.unscoped()).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 6, 1] and vectors.top_k(table, table.limit(0), "vec_id", "embedding", 3, retrieval.unscoped()).count() == 0
    stored = spark.createDataFrame([("p", "d", "v1"), ("q", "d", "v2")], "point_id string, document_id string, source_version string")
    assert vectors.upsert(stored, spark.createDataFrame([("q", "e", "v1"), ("r", "e", "v1")], stored.schema)).count() == 3
    assert [r.point_id for r in vectors.without_version(stored, stored.where("source_version = 'v1'")).collect()] == ["q"]


def test_retrieval(spark):
    docs = spark.createDataFrame([(1, "red bolt and nut"), (2, "red paint"), (3, "green bolt bolt"), (4, None)], "id int, body string")
    queries = spark.createDataFrame([("q", "Bolt"), ("none", "zzz")], "query_id string, query_text string")
    found = retrieval.bm25(docs, "id", "body", queries, retrieval.unscoped())
    assert [(r.id, r["rank"]) for r in found.orderBy("rank").collect()] == [(3, 1), (1, 2)]
    fused = retrieval.fused([found, found.where("id = 1").withColumn("rank", F.lit(1))], "id").orderBy("rank").collect()
    assert [r.id for r in fused] == [1, 3]
    scopes = spark.createDataFrame([(["g1"], None), (None, ["me"]), (["x"], []), (None, None)], "g array<string>, u array<string>")
    assert [r.ok for r in scopes.select(retrieval.permitted(F.col("g"), F.col("u"), ["g1"], "me").alias("ok")).collect()] == [True, True, False, False]
    assert one(spark, retrieval.parsed_intent(F.lit('```json\n{"intent": "general_chat"}\n```'), F.lit("hi"))).resolved_query == "hi" and one(spark, retrieval.parsed_intent(F.lit("?"), F.lit("hi"))).intent == "Domain_qn"
    turns = spark.createDataFrame([("c", n) for n in range(7)], "conversation_id string, turn int")
    assert sorted(r.turn for r in retrieval.last_turns(turns).collect()) == [3, 4, 5, 6]


def test_workbook(spark):
    rows = [("s", 1, 1, "Sensors 2024", "string"), ("s", 2, 1, "Name", "string"), ("s", 2, 2, "Range", "string"), ("s", 2, 3, "name", "string"), ("s", 3, 1, "Radar", "string"), ("s", 3, 2, "120", "integer"), ("s", 3, 3, "None", "string"), ("s", 9, 1, "a note of some length that is text", "string")]
    cells = workbook.cleaned(spark.createDataFrame(rows, "sheet_id string, row int, col int, value string, kind string"))
    assert [(r.first_row, r.last_row) for r in workbook.regions(cells).orderBy("region_no").collect()] == [(1, 3), (9, 9)]
    head = workbook.headers(cells).orderBy("region_no").first()
    assert (head.header_row, head.title) == (2, "Sensors 2024")
    images = spark.createDataFrame([("s", 9), ("s", 20), ("s", 21)], "sheet_id string, row int")
    assert [r.classification for r in workbook.classified(cells, images).orderBy("region_no").collect()][1] == "IMAGE_HEAVY"
    assert [r.row_range for r in workbook.image_only_rows(images, cells).collect()] == ["20-21"]
    labels = spark.createDataFrame([(1, "Name"), (2, None), (3, "name "), (4, "NAME")], "p int, label string").withColumn("k", F.lit(1))
    assert [r.column_name for r in workbook.column_names(labels, ["k"], "p", "label").orderBy("p").collect()] == ["name", "column_2", "name_2", "name_3"]
    near = workbook.nearby_text(cells, spark.createDataFrame([("i", "s", 1)], "anchor_id string, sheet_id string, anchor_row int")).first()
    assert near.text == "Row 1: Sensors 2024\nRow 2: Name | Range | name\nRow 3: Radar | 120"


def plan_of(df):
    """The plan as it ran, with what was decided on the way."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def stored_cells(spark, folder):
    """A table file so small that Spark would broadcast whatever comes from it."""
    rows = [("s", 1, 1, "Sensors", "string"), ("s", 2, 1, "Name", "string"), ("s", 2, 2, "Range", "string"), ("s", 3, 1, "Radar", "string"), ("s", 3, 2, "120", "integer"), ("s", 9, 1, "a note", "string"), ("t", 1, 1, "Name", "string"), ("t", 1, 2, "Unit", "string"), ("t", 2, 2, "mm", "string"), (None, 1, 1, "lost", "string")]
    spark.createDataFrame(rows, "sheet_id string, row int, col int, value string, kind string").write.parquet(f"{folder}/cells")
    return spark.read.parquet(f"{folder}/cells")


def test_workbook_tree_broadcasts_nothing(spark, tmp_path):
    nodes = workbook.tree("w", stored_cells(spark, tmp_path))
    assert "Broadcast" not in plan_of(nodes)
    assert {r.node_type: r["count"] for r in nodes.groupBy("node_type").count().collect()} == {"workbook": 1, "sheet": 3, "region": 3, "table": 2, "table_row": 2, "table_cell": 3}


def test_sheet_rows_broadcast_nothing(spark, tmp_path):
    cells = stored_cells(spark, tmp_path)
    data, head = workbook.table_rows(cells), workbook.headers(cells)
    assert "Broadcast" not in plan_of(data) and "Broadcast" not in plan_of(head)
    assert {(r.sheet_id, r.table_name, r.row, r.column_name, r.value) for r in data.collect()} == {("s", "sensors", 3, "name", "Radar"), ("s", "sensors", 3, "range", "120"), ("t", "table_1", 2, "unit", "mm")}
    assert {tuple(r) for r in head.collect()} == {("s", 0, 2, "Sensors"), ("s", 1, None, "a note"), ("t", 0, 1, None)}


def packed(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        for name, body in files.items():
            package.writestr(name, body)
    return out.getvalue()


def office_files():
    r, w, a, s = "http://r", "http://w", "http://a", "http://s"
    rels = f'<Relationships><Relationship Id="rId1" Target="{{}}"/></Relationships>'
    xlsx = packed(**{"xl/workbook.xml": f'<workbook xmlns="{s}" xmlns:r="{r}"><sheets><sheet name="One" r:id="rId1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rels.format("worksheets/sheet1.xml"), "xl/sharedStrings.xml": f'<sst xmlns="{s}"><si><t>Sensor</t></si></sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{s}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C2"><f>1+2</f><v>3</v></c><c r="B2" t="e"><v>#VALUE!</v></c><c r="D4" t="b"><v>1</v></c></row></sheetData></worksheet>'})
    docx = packed(**{"word/document.xml": f'<w:document xmlns:w="{w}" xmlns:r="{r}" xmlns:a="{a}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Ti</w:t></w:r><w:r><w:t>tle</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>line</w:t><w:br/><w:t>two</w:t></w:r><a:blip r:embed="rId1"/></w:p></w:body></w:document>', "word/_rels/document.xml.rels": rels.format("media/i.png"), "word/media/i.png": b"png"})
    pptx = packed(**{"ppt/slides/slide10.xml": f'<p:sld xmlns:p="{s}" xmlns:a="{a}"><p:sp><p:nvPr><p:ph type="title"/></p:nvPr><a:p><a:r><a:t>Ten</a:t></a:r></a:p></p:sp></p:sld>', "ppt/slides/slide2.xml": f'<p:sld xmlns:p="{s}" xmlns:a="{a}"><p:sp><a:p><a:pPr lvl="1"/><a:r><a:t>Two</a:t></a:r></a:p></p:sp></p:sld>', "ppt/slides/_rels/slide2.xml.rels": rels.format("../notesSlides/n.xml"), "ppt/notesSlides/n.xml": f'<p:notes xmlns:p="{s}" xmlns:a="{a}"><a:p><a:r><a:t>Say it</a:t></a:r></a:p></p:notes>'})
    page = b"<html><head><title>T</title><style>p{}</style></head><body><h2>H</h2><p>a<br>b<script>x()</script></p><ul><li>i</li></ul><table><tr><td>1</td><td>2</td></tr></table></body></html>"
    return {"a.xlsx": xlsx, "b.docx": docx, "c.pptx": pptx, "d.html": page, "e.pdf": b"%PDF", "f.docx": b"broken", "g.txt": b"one\n\ntwo"}


def test_office_files(spark, tmp_path):
    for name, body in office_files().items():
        (tmp_path / name).write_bytes(body)
    rows = office.blocks(office.read_files(spark, str(tmp_path))).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.path, r.ord)):
        got.setdefault(r.path.rpartition("/")[2], []).append((r.part, r.kind, r.text or r.error))
    assert got["a.xlsx"] == [(1, "sheet", "One"), (1, "cell", "Sensor"), (1, "cell", "=1+2"), (1, "cell", "#VALUE!"), (1, "cell", "TRUE")]
    assert got["b.docx"] == [(1, "heading", "Title"), (1, "cell", "x"), (1, "paragraph", "line\ntwo"), (1, "image", "i.png")]
    assert got["c.pptx"] == [(1, "bullet", "Two"), (1, "notes", "Say it"), (2, "title", "Ten")]
    assert [(k, t) for _, k, t in got["d.html"]] == [("title", "T"), ("heading", "H"), ("paragraph", "a b"), ("bullet", "i"), ("cell", "1"), ("cell", "2")]
    assert got["e.pdf"][0][1:] == ("error", "unsupported") and got["f.docx"][0][1:] == ("error", "BadZipFile") and len(got["g.txt"]) == 2


def test_streaming_ingest_adds_each_content_once(spark, tmp_path):
    files, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    files.mkdir()
    (files / "a.txt").write_bytes(b"one")
    (files / "copy.txt").write_bytes(b"one")
    ingest.ingest_files(spark, str(files), target, state).awaitTermination()
    (files / "b.txt").write_bytes(b"two")
    (files / "late.txt").write_bytes(b"one")
    ingest.ingest_files(spark, str(files), target, state).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(target).collect()) == ["one", "two"]


def test_guard(spark):
    spark.range(5).createOrReplaceTempView("allowed_t")
    assert guarded_sql(spark, "WITH c AS (SELECT id FROM allowed_t WHERE id > :n) SELECT count(*) AS n FROM c", {"allowed_t"}, args={"n": 1}).result.first().n == 3
    assert guarded_sql(spark, "SELECT * FROM allowed_t", {"allowed_t"}, limit=2).result.count() == 2
    spark.range(1).createOrReplaceTempView("secret")
    for good in ("SELECT a.id FROM allowed_t a JOIN (SELECT max(id) AS m FROM allowed_t) b ON a.id = b.m WHERE a.id IN (SELECT id FROM allowed_t)", "SELECT id, row_number() OVER (PARTITION BY id % 2 ORDER BY id) AS n FROM allowed_t", "WITH a AS (SELECT 1 AS x), b AS (SELECT x FROM a) SELECT CASE WHEN x > 0 THEN upper('y') END AS y FROM b UNION ALL SELECT 'z'"):
        assert guarded_sql(spark, good, {"allowed_t"}).result.count() > 0
    for bad in ("DROP TABLE allowed_t", "SELECT * FROM other", "INSERT INTO allowed_t VALUES (1)", "SELECT 1; SELECT 2", "CREATE TABLE x AS SELECT 1", "SHOW TABLES", "nonsense", "SELECT * FROM (SELECT * FROM hidden)",
                "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret", "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM allowed_t", "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT * FROM range(5)", "SELECT * FROM allowed_t.secret",
                "SELECT * FROM allowed_t WHERE id IN (SELECT id FROM secret)", "SELECT (SELECT max(id) FROM secret)", "SELECT * FROM allowed_t WHERE EXISTS (SELECT 1 FROM secret)", "SELECT * FROM (WITH a AS (SELECT 1) SELECT * FROM a) x JOIN a ON true", "SELECT * FROM parquet.`/tmp/x`", "SELECT explode(array(1)) FROM allowed_t"):
        with pytest.raises(Refused):
            guarded_sql(spark, bad, {"allowed_t"})


def test_guard_deadline_and_log(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("allowed_t")
    rows, log = guarded_sql(spark, "SELECT id FROM allowed_t", {"allowed_t"}, caller="u").run()
    assert len(rows) == 5 and (log.status, log.n_rows, log.caller, log.tables) == ("ok", 5, "u", ["allowed_t"])
    spark.range(0, 400_000_000, 1, 4).selectExpr("id", "xxhash64(id, 1) AS h").createOrReplaceTempView("allowed_big")
    rows, late = guarded_sql(spark, "SELECT count(*) AS n FROM allowed_big a JOIN allowed_big b ON a.h = b.h", {"allowed_big"}).run(timeout=1)
    assert not rows and late.status == "timeout"
    write_log(spark, [log, late, refused_row("DROP TABLE x", "no")], str(tmp_path / "log"))
    assert sorted(r.status for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["ok", "refused", "timeout"]


def test_agents(spark, tmp_path):
    (tmp_path / "x.yaml").write_text("agent_id: brake-agent\ndisplay_name: 'Brakes'\nui:\n  route: /agents/brake\nraw_folder: raw/x # here\n")
    row = agents.read_agents(spark, str(tmp_path)).first()
    assert (row.agent_id, row.display_name, row.route, row.raw_folder) == ("brake-agent", "Brakes", "/agents/brake", "raw/x")
    with pytest.raises(Exception, match="invalid agent name"):
        spark.range(1).select(T.collection_name(F.lit("a b"))).collect()
