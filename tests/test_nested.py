import json

from lectern.operators import nested


def test_invalid_and_encoded_records():
    good = {"node_id": "a", "children": {"node_id": 5, "x": [{"node_id": None, "y": [{"node_id": "c"}]}]}}
    text = json.dumps(good)
    for form in (text, "\n  " + text + "  ", json.dumps(good, indent=1), json.dumps(text), json.dumps(json.dumps(json.dumps(json.dumps(text))))):
        links = [(m[3], m[4]) for m in nested.visit(nested.parse_record(form), "node_id") if m[3] is not None]
        assert links == [("a", ""), ("5", "a"), ("c", "5")]
    for form in (None, "", " ", text[:-3], "nonsense", '{"a": NaN}', '{"a": 1,}', '"just text"', "7"):
        assert nested.parse_record(form) is None


def test_deeper_than_the_library_parses():
    deep = '{"node_id": "n", "c": [' * 30_000 + '"e\\u00e9", -1.5e3, true, null, {}, []' + "]}" * 30_000
    value = nested._decode_deep(deep)
    assert sum(1 for _ in nested.visit(value, "node_id")) == 30_001
    small = json.dumps({"a": [1, -2.5, "x\n\"", {"b": {}}, [], None, True]})
    assert nested._decode_deep(small) == json.loads(small)


def test_tables_keep_links(spark, tmp_path):
    record = {"node_id": "r", "title": "t", "meta": {"k": 1}, "rows": [{"node_id": "x", "text": "a", "prov": [{"p": "1"}, {"p": 2}]}, {"node_id": "x"}]}
    rows = [(1, json.dumps(record), "d1", 4), (1, json.dumps(record), "d1", 4), (2, None, "d2", 4), (None, "{}", "d3", 4), (3, "[]", "d", 4)]
    df = spark.createDataFrame(rows, "artifact_id bigint, master_json string, id string, depth int")
    tagged = nested.emit_tagged(df, "artifact_id", "master_json", "master", "node_id").dropDuplicates(["record_kind", "record_id", "row_no"])
    by_row = {r.row_no: r for r in tagged.collect()}
    assert {r.tag for r in by_row.values()} == {"node", "meta", "prov"}
    assert all(r.parent_row == -1 or r.parent_row in by_row for r in by_row.values())
    nested.write_tables(tagged, str(tmp_path / "tables"))
    prov = nested.flat_table(spark.read.parquet(str(tmp_path / "tables")), "prov", "p string")
    assert sorted(r.p for r in prov.collect()) == ["1", "2"]
    exports = spark.createDataFrame([(5, '{"self_ref": "#/a", "children": [{"self_ref": "#/b"}]}', 1)], "extraction_id bigint, exported string, tag int")
    links = nested.node_links(df, exports)
    assert {tuple(r) for r in links.collect()} == {("master", 1, "r", ""), ("master", 1, "x", "r"), ("exported", 5, "#/a", ""), ("exported", 5, "#/b", "#/a")}
    assert nested.node_links(df.limit(0), exports.limit(0)).count() == 0
    assert {(r.tag, r.n_rows) for r in nested.table_sizes(df, exports).collect()} == {("node", 3), ("meta", 1), ("prov", 2), ("node", 2)}


def test_links_come_from_the_written_table(spark, monkeypatch):
    df = spark.createDataFrame([(1, '{"node_id": "r"}')], "artifact_id bigint, master_json string")
    none = spark.createDataFrame([], "extraction_id bigint, exported string")
    written = []
    plain = nested.write_tables
    monkeypatch.setattr(nested, "write_tables", lambda tagged, path, mode="errorifexists": (written.append(path), plain(tagged.limit(0), path, mode)))
    assert nested.node_links(df, none).count() == 0 and len(written) == 1


def test_payload_keeps_lists_of_lists_and_mixed_lists():
    deep = value = []
    for _ in range(50_000):
        value.append([])
        value = value[0]
    value.append(1)
    here = {"a": 1, "grid": [[1, 2], ["x\n", None]], "mixed": [1, {"k": 2}, "y"], "inner": [[{"k": 3}], 4], "children": [{"k": 5}], "empty": [[]], "own": {"k": 6}, "flat": [7]}
    assert json.loads(nested._payload(here)) == {"a": 1, "grid": [[1, 2], ["x\n", None]], "mixed": [1, None, "y"], "inner": [[None], 4], "empty": [[]], "flat": [7]}
    assert json.loads(nested._payload({"grid": [[1]]})) == {"grid": [[1]]} and nested._payload({"children": [{}]}) == "{}"
    assert nested._payload({"d": deep}) == '{"d": ' + "[" * 50_001 + "1" + "]" * 50_001 + "}"
