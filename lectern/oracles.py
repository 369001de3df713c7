"""SQL equivalents of the core queries, for DuckDB over the same tables.

Written independently of the Spark plans: window functions, list functions and regular expressions of DuckDB. Queries that
SQL can't express (folds in document order, parsers, model providers) have none; tests cover them instead.
"""

from __future__ import annotations

_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TOKEN = r"[a-z0-9]+(?:[./_-][a-z0-9]+)*"
_SEARCHES = "(VALUES ('q1', 'torque audit of the busbar'), ('q2', 'shaker run gasket leaked'), ('q3', 'Dichtung nach dem Lackieren gerissen')) q(query_id, query_text)"


def norm(x: str) -> str:
    return f"nullif(regexp_replace(regexp_replace({x}, '{_BLANK}+', ' ', 'g'), '^ | $', '', 'g'), '')"


def fold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({fold(x)}, '{_TOKEN}')"


def values(x: str) -> str:
    # The second alternative eats other words whole, so that the first begins at word boundaries of any script.
    found = rf"list_filter(regexp_extract_all({x}, '([a-zA-Z]*\p{{Nd}}(?:[\p{{L}}\p{{N}}_./-]*[\p{{L}}\p{{N}}_])?)|[\p{{L}}\p{{N}}_]+', 1), lambda v: v <> '')"
    return f"list_sort(list_distinct(list_transform({found}, lambda v: {fold('v')})))"


def _compared(a: str, b: str, name: str) -> str:
    return f"""SELECT chunk_id, CASE WHEN b = '' THEN 'empty' WHEN a = '' THEN 'fallback_only' WHEN {fold('a')} = {fold('b')} THEN 'duplicate'
 WHEN nb >= 4 AND share >= 0.7 AND len(va) > 0 AND len(vb) > 0 AND len(list_filter(va, lambda v: NOT list_contains(vb, v))) > 0 AND len(list_filter(vb, lambda v: NOT list_contains(va, v))) > 0 THEN 'conflict'
 WHEN contains({fold('a')}, {fold('b')}) OR share >= 0.9 THEN 'near_duplicate' ELSE 'fallback_only' END AS {name}
FROM (SELECT chunk_id, a, b, len(tb) AS nb, {values('a')} AS va, {values('b')} AS vb,
  CASE WHEN len(tb) = 0 THEN 1.0 ELSE coalesce((SELECT sum(least(y.n, x.n)) FROM (SELECT u, count(*) n FROM (SELECT unnest(tb) u) GROUP BY u) y JOIN (SELECT u, count(*) n FROM (SELECT unnest(ta) u) GROUP BY u) x USING (u)), 0)::double / len(tb) END AS share
 FROM (SELECT chunk_id, a, b, {tokens('a')} AS ta, {tokens('b')} AS tb FROM (SELECT DISTINCT chunk_id, coalesce({norm(a)}, '') AS a, coalesce({norm(b)}, '') AS b FROM chunks)))"""


def _lines(table: str, key: str, text: str) -> str:
    return f"""SELECT {key}, i - 1 AS line_no, regexp_replace(lines[i], '^{_BLANK}+|{_BLANK}+$', '', 'g') AS line
 FROM (SELECT {key}, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT {key}, regexp_split_to_array({text}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS lines FROM {table}))
 WHERE {norm('lines[i]')} IS NOT NULL"""


_HEADING = rf"""(CASE WHEN regexp_replace(n, '^[# ]+', '') = '' THEN 0 ELSE len(string_split(regexp_replace(n, '^[# ]+', ''), ' ')) END BETWEEN 1 AND 12
 AND (starts_with(n, '#') OR ends_with(n, ':') OR length(regexp_replace(n, '[^\p{{Lu}}]', '', 'g'))::double / greatest(length(n), 1) > 0.45))"""
_BULLET = "regexp_matches(n, '^(?:[-*>]|o )')"
_HEADING_TEXT = f"coalesce({norm(chr(114) + 'egexp_replace(line, ' + chr(39) + '^[# ]+' + chr(39) + ', ' + chr(39) * 2 + ')')}, line)"
_BULLET_TEXT = "nullif(CASE WHEN n IN ('-', '*', '>') THEN '' ELSE trim(regexp_replace(n, '^(?:[-*>o] )', '')) END, '')"
_DOC_LINES = f"SELECT doc_id, line_no, line, {norm('line')} AS n FROM ({_lines('documents', 'doc_id', 'text')})"
_NODES = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY group_no) - 1 AS node_no, node_type, text FROM (
 SELECT doc_id, group_no, node_type, CASE node_type WHEN 'title_block' THEN {_HEADING_TEXT} WHEN 'bullet_block' THEN {_BULLET_TEXT} ELSE n END AS text
 FROM (SELECT doc_id, group_no, node_type, line, {norm('line')} AS n FROM (
  SELECT doc_id, group_no, any_value(kind) AS node_type, string_agg(line, ' ' ORDER BY line_no) AS line FROM (
   SELECT *, sum(CASE WHEN kind <> 'paragraph' OR coalesce(before, '') <> 'paragraph' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS group_no FROM (
    SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM (
     SELECT doc_id, line_no, line, CASE WHEN {_HEADING} THEN 'title_block' WHEN {_BULLET} THEN 'bullet_block' ELSE 'paragraph' END AS kind FROM ({_DOC_LINES})))) GROUP BY doc_id, group_no)))
 WHERE text IS NOT NULL"""


def _bm25(table: str, key: str, text: str, k: int) -> str:
    return f"""SELECT query_id, {key}, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS rank FROM (
 SELECT query_id, {key}, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
 FROM (SELECT {key}, t AS token, count(*) AS tf, any_value(dl) AS dl FROM (SELECT {key}, len(ts) AS dl, unnest(ts) AS t FROM (SELECT {key}, {tokens(text)} AS ts FROM {table})) GROUP BY {key}, t) p
 JOIN (SELECT DISTINCT query_id, unnest({tokens('query_text')}) AS token FROM {_SEARCHES}) q USING (token)
 JOIN (SELECT t AS token, count(DISTINCT {key}) AS df FROM (SELECT {key}, unnest({tokens(text)}) AS t FROM {table}) GROUP BY t) d USING (token),
 (SELECT count(*) AS n, avg(dl) AS avgdl FROM (SELECT len({tokens(text)}) AS dl FROM {table}) WHERE dl > 0) s
 GROUP BY query_id, {key}) QUALIFY rank <= {k}"""


_GROUPS = "['grp-brake', 'grp-thermal', 'grp-harness']"
_CHUNKS_ONCE = f"(SELECT DISTINCT chunk_id, document_id, parent_node_id, chunk_type, content_text FROM chunks WHERE list_has_any(CAST(json_extract(metadata, '$.security_scope.allowed_groups') AS VARCHAR[]), {_GROUPS}))"
_TREE = r"""
WITH r AS (SELECT DISTINCT artifact_id, master_json AS j FROM canonical_artifacts WHERE json_valid(master_json)),
v AS (SELECT artifact_id, CASE WHEN json_type(j) <> 'VARCHAR' THEN j WHEN json_valid(json_extract_string(j, '$')) THEN json_extract_string(j, '$') END AS j FROM r),
n AS (SELECT artifact_id, fullkey, value AS v, row_number() OVER (PARTITION BY artifact_id ORDER BY e.id) - 1 AS ord, regexp_replace(fullkey, '\.children(\[\d+\])?$', '') AS up, json_extract(value, '$.attributes.retrieval_allowed') = 'false' AS review
 FROM v, json_tree(v.j) e WHERE e.type = 'OBJECT' AND regexp_matches(fullkey, '^\$\.root_nodes(\[\d+\])?(\.children(\[\d+\])?)*$')),
t AS (SELECT n.artifact_id, n.ord, json_extract_string(n.v, '$.node_id') AS node_id, json_extract_string(n.v, '$.node_type') AS node_type, json_extract_string(n.v, '$.provenance.page_number') AS page_number, n.v AS v,
 coalesce(p.ord, -1) AS parent_ord, (len(n.fullkey) - len(replace(n.fullkey, '.children', ''))) // 9 AS depth, coalesce(n.review, false) AS review,
 (SELECT count(*) FROM n c WHERE c.artifact_id = n.artifact_id AND c.up = n.fullkey AND c.fullkey <> n.fullkey) AS n_children,
 EXISTS (SELECT 1 FROM n a WHERE a.artifact_id = n.artifact_id AND a.review AND (n.fullkey = a.fullkey OR starts_with(n.fullkey, a.fullkey || '.children'))) AS blocked
 FROM n LEFT JOIN n p ON p.artifact_id = n.artifact_id AND p.fullkey = n.up AND p.fullkey <> n.fullkey)"""
_ELEMENTS = r"""
WITH v AS (SELECT extraction_id, CASE WHEN json_type(j) <> 'VARCHAR' THEN j WHEN json_valid(json_extract_string(j, '$')) THEN json_extract_string(j, '$') END AS j FROM (SELECT DISTINCT extraction_id, exported AS j FROM extraction_results WHERE json_valid(exported))),
t AS (SELECT extraction_id AS record_id, json_extract_string(value, '$.self_ref') AS self_ref, json_extract_string(value, '$.label') AS label,
 CASE WHEN try_cast(coalesce(json_extract_string(value, '$.prov[0].page_no'), json_extract_string(value, '$.prov.page_no')) AS INT) >= 1 THEN try_cast(coalesce(json_extract_string(value, '$.prov[0].page_no'), json_extract_string(value, '$.prov.page_no')) AS INT) END AS page_no,
 CASE WHEN trim(json_extract_string(value, '$.text')) <> '' THEN length(json_extract_string(value, '$.text')) END AS chars FROM v, json_tree(v.j) e WHERE e.type = 'OBJECT' AND json_extract_string(value, '$.self_ref') IS NOT NULL)"""
_CELLS = """(SELECT c_custkey, unnest([{'col': 1, 'column_name': 'c_name', 'value': c_name}, {'col': 2, 'column_name': 'c_nationkey', 'value': c_nationkey::varchar}, {'col': 3, 'column_name': 'c_acctbal', 'value': c_acctbal::varchar}, {'col': 4, 'column_name': 'c_mktsegment', 'value': c_mktsegment}], recursive := true) FROM customer)"""
_KIND = r"""CASE WHEN value IS NULL OR trim(value) = '' THEN 'empty' WHEN lower(trim(value)) IN ('true', 'false') THEN 'boolean' WHEN regexp_matches(trim(value), '^[+-]?\d+$') THEN 'integer' WHEN regexp_matches(trim(value), '^[+-]?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?$') THEN 'float' ELSE 'string' END"""
_SHEET = f"""(SELECT *, {_KIND} AS kind FROM (SELECT p_brand AS sheet_id, p_partkey::int AS row, unnest([{{'col': 1, 'value': p_name}}, {{'col': 2, 'value': p_type}}, {{'col': 3, 'value': p_size::varchar}}, {{'col': 4, 'value': p_retailprice::varchar}}], recursive := true) FROM part) WHERE value IS NOT NULL AND trim(value) <> '')"""
_REGIONS = f"""(SELECT sheet_id, row_number() OVER (PARTITION BY sheet_id ORDER BY first_row) - 1 AS region_no, first_row, last_row FROM (
 SELECT sheet_id, min(row) AS first_row, max(row) AS last_row FROM (SELECT sheet_id, row, row - row_number() OVER (PARTITION BY sheet_id ORDER BY row) AS run FROM (SELECT DISTINCT sheet_id, row FROM {_SHEET})) GROUP BY sheet_id, run))"""
_CLASSIFIED = f"""SELECT sheet_id, region_no, first_row, last_row, 'A' || first_row || ':D' || last_row AS cell_range,
 CASE WHEN numbers::double / populated > 0.25 OR (widest >= 3 AND shapes <= 3) THEN CASE WHEN long_n::double / populated < 0.4 THEN 'STRUCTURED' ELSE 'MIXED' END ELSE 'DOCUMENT_LIKE' END AS classification, populated, round(numbers::double / populated, 4) AS numeric_ratio
FROM (SELECT sheet_id, region_no, first_row, last_row, sum(n)::bigint AS populated, sum(num) AS numbers, sum(lng) AS long_n, max(n) AS widest, count(DISTINCT CASE WHEN row < first_row + 4 THEN n END) AS shapes
 FROM (SELECT sheet_id, region_no, first_row, last_row, row, count(*) AS n, count(*) FILTER (kind IN ('boolean', 'integer', 'float')) AS num, count(*) FILTER (kind = 'string' AND length(value) > 24) AS lng
  FROM {_SHEET} JOIN {_REGIONS} r USING (sheet_id) WHERE row BETWEEN first_row AND last_row AND row < first_row + 12 GROUP BY ALL) GROUP BY ALL)"""
_ISSUE_NODES = """(SELECT document_id AS record_id, created_at AS ord, chunk_id AS node_id, parent_node_id AS parent_id, CASE WHEN chunk_type = 'table_row' THEN 'table' ELSE 'paragraph' END AS node_type, content_text AS text, policy_version IS NULL AS review FROM chunks)"""
_ISSUES = f"""SELECT record_id, node_id, 'error' AS severity, 'duplicate_node_id' AS code FROM (SELECT *, row_number() OVER (PARTITION BY record_id, node_id ORDER BY ord) AS k FROM {_ISSUE_NODES}) WHERE k > 1
 UNION ALL SELECT record_id, node_id, 'warning', 'duplicate_content' FROM (SELECT *, row_number() OVER (PARTITION BY record_id, node_type, {fold(f"regexp_replace(text, '^{_BLANK}+|{_BLANK}+$', '', 'g')")}, parent_id ORDER BY ord) AS k FROM {_ISSUE_NODES} WHERE node_type = 'paragraph' AND text IS NOT NULL AND text <> '') WHERE k > 1
 UNION ALL SELECT record_id, node_id, 'warning', 'unreadable_table' FROM {_ISSUE_NODES} WHERE node_type = 'table' AND review
 UNION ALL SELECT record_id, node_id, 'warning', 'incomplete_table' FROM {_ISSUE_NODES} WHERE node_type = 'table' AND text IS NULL
 UNION ALL SELECT record_id, NULL, 'error', 'no_extracted_content' FROM {_ISSUE_NODES} GROUP BY record_id HAVING max(coalesce(length(trim(text)), 0)) = 0"""
_VALID = "coalesce(len(embedding) = dimensions AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)"
_SCOPE = "list_transform(json_extract_string(metadata, '$.security_scope.allowed_groups[*]'), lambda g: g)"


def sql() -> dict[str, str]:
    use = "CASE WHEN regexp_matches({0}, '(?i)\\b(link|url|webinar|presentation|ppt|pdf|document path|file path|reference location)\\b') OR regexp_matches(replace({0}, '_', ' '), '(?i)\\b(link|url|webinar|presentation|ppt|pdf|document path|file path|reference location)\\b') THEN 'reference_link' WHEN regexp_matches({0}, '(?i)\\b(internal note|email)\\b') OR regexp_matches(replace({0}, '_', ' '), '(?i)\\b(internal note|email)\\b') THEN 'internal_only' ELSE 'standard' END"
    return {
        "text_normalised": f"SELECT doc_id, length(n) AS n_chars_normalised, sha256(n)[1:16] AS digest FROM (SELECT doc_id, {norm('text')} AS n FROM documents)",
        "token_counts": f"SELECT token, count(*) AS n FROM (SELECT unnest({tokens('text')}) AS token FROM documents) GROUP BY token",
        "token_topk": f"SELECT lang, token, n FROM (SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({tokens('text')}) AS token FROM documents WHERE lang IS NOT NULL) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) <= 15",
        "technical_values": f"SELECT doc_id, array_to_string({values('text')}, '|') AS technical_values FROM documents",
        "text_compared": f"SELECT * FROM ({_compared('embedding_text', 'content_text', 'content_in_embedding')}) JOIN ({_compared('content_text', 'upper(content_text)', 'against_upper')}) USING (chunk_id) JOIN ({_compared('content_text', chr(114) + 'eplace(content_text, ' + repr('1') + ', ' + repr('7') + ')', 'against_altered')}) USING (chunk_id)",
        "headings_and_bullets": f"SELECT doc_id, line_no, {_HEADING} AS is_heading, {_BULLET} AS is_bullet, {_HEADING_TEXT} AS heading_text, {_BULLET_TEXT} AS bullet_text FROM ({_DOC_LINES})",
        "inferred_titles": f"SELECT d.doc_id, coalesce(t.title, d.document_title, 'untitled') AS title FROM documents d LEFT JOIN (SELECT doc_id, min_by(coalesce({norm(chr(114) + 'egexp_replace(n, ' + repr('^[# ]+') + ', ' + repr('') + ')')}, n), line_no) AS title FROM ({_DOC_LINES}) WHERE {_HEADING} GROUP BY doc_id) t USING (doc_id)",
        "lines_to_nodes": _NODES,
        "section_carry_forward": f"SELECT doc_id, section_no, section_title, count(*) AS n_nodes FROM (SELECT doc_id, sum((node_type = 'title_block')::int) OVER w AS section_no, last_value(CASE WHEN node_type = 'title_block' THEN text END IGNORE NULLS) OVER w AS section_title FROM ({_NODES}) WINDOW w AS (PARTITION BY doc_id ORDER BY node_no ROWS UNBOUNDED PRECEDING)) GROUP BY ALL",
        "branch_nodes": f"SELECT 'semantic' AS branch, node_type, count(*) AS n FROM ({_NODES}) GROUP BY node_type",
        "markdown_sections": f"""SELECT extraction_id, row_number() OVER (PARTITION BY extraction_id ORDER BY part) - 1 AS section_no, length(regexp_replace(section, '^{_BLANK}+|{_BLANK}+$', '', 'g')) AS n_chars FROM (
 SELECT extraction_id, part, string_agg(line, chr(10) ORDER BY i) AS section FROM (SELECT *, sum((starts_with(line, '#') AND i > 1)::int) OVER (PARTITION BY extraction_id ORDER BY i) AS part FROM (
  SELECT extraction_id, i, l[i] AS line FROM (SELECT extraction_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT DISTINCT extraction_id, string_split(replace(markdown, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM extraction_results WHERE markdown IS NOT NULL)))) GROUP BY extraction_id, part) WHERE {norm('section')} IS NOT NULL""",
        "markdown_blocks": f"""SELECT extraction_id, i - 1 AS block_no, length(regexp_replace(l[i], '^{_BLANK}+|{_BLANK}+$', '', 'g')) AS n_chars FROM (SELECT extraction_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT DISTINCT extraction_id, string_split(replace(markdown, chr(13) || chr(10), chr(10)), chr(10) || chr(10)) AS l FROM extraction_results WHERE markdown IS NOT NULL)) WHERE {norm('l[i]')} IS NOT NULL""",
        "duplicate_content": f"SELECT doc_id, k AS occurrence FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256({fold(norm('text'))}) ORDER BY doc_id) AS k FROM documents WHERE {norm('text')} IS NOT NULL) WHERE k > 1",
        "multiset_difference": f"SELECT {norm('source')} AS source, lang FROM documents EXCEPT ALL SELECT source, lang FROM documents",
        "multiset_intersection": f"SELECT {norm('source')} AS source, lang FROM documents INTERSECT ALL SELECT source, lang FROM documents",
        "missing_tokens": f"SELECT token, a.n - coalesce(b.n, 0) AS missing FROM (SELECT token, count(*) n FROM (SELECT unnest({tokens('embedding_text')}) AS token FROM (SELECT DISTINCT chunk_id, content_text, embedding_text FROM chunks)) GROUP BY token) a LEFT JOIN (SELECT token, count(*) n FROM (SELECT unnest({tokens('content_text')}) AS token FROM (SELECT DISTINCT chunk_id, content_text, embedding_text FROM chunks)) GROUP BY token) b USING (token) WHERE a.n > coalesce(b.n, 0) ORDER BY missing DESC, token LIMIT 20",
        "coverage_by_document": f"SELECT document_id, sum(least(a.n, coalesce(b.n, 0)))::bigint AS covered, sum(a.n)::bigint AS total, round(sum(least(a.n, coalesce(b.n, 0)))::double / sum(a.n), 4) AS share FROM (SELECT document_id, token, count(*) n FROM (SELECT document_id, unnest({tokens('embedding_text')}) AS token FROM (SELECT DISTINCT chunk_id, document_id, content_text, embedding_text FROM chunks)) GROUP BY ALL) a LEFT JOIN (SELECT document_id, token, count(*) n FROM (SELECT document_id, unnest({tokens('content_text')}) AS token FROM (SELECT DISTINCT chunk_id, document_id, content_text, embedding_text FROM chunks)) GROUP BY ALL) b USING (document_id, token) GROUP BY document_id",
        "phrase_matches": f"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string({tokens('text')}, ' ') || ' ', ' torque audit ')",
        "measurements": "SELECT 'kg' AS unit, sum(l_quantity::int)::double AS total, count(*) AS n FROM lineitem",
        "p3_found": r"""
WITH RECURSIVE r AS (SELECT 'master' AS k, artifact_id AS id, master_json AS j, 'node_id' AS f FROM canonical_artifacts UNION SELECT 'exported', extraction_id, exported, 'self_ref' FROM extraction_results),
v AS (SELECT k, id, f, CASE WHEN json_type(j) <> 'VARCHAR' THEN j WHEN json_valid(json_extract_string(j, '$')) THEN json_extract_string(j, '$') END AS j FROM r WHERE json_valid(j)),
t AS MATERIALIZED (SELECT v.k, v.id AS record, e.id AS pos, e.parent AS up, CASE WHEN e.type = 'OBJECT' THEN json_extract_string(e.value, '$.' || v.f) END AS own FROM v, json_tree(v.j) e),
d AS (SELECT k, record, pos, own, '' AS parent_id, coalesce(own, '') AS below FROM t WHERE up IS NULL
 UNION ALL SELECT t.k, t.record, t.pos, t.own, d.below, coalesce(t.own, d.below) FROM t JOIN d ON t.k = d.k AND t.record = d.record AND t.up = d.pos)
SELECT DISTINCT k AS record_kind, record AS record_id, own AS node_id, parent_id FROM d WHERE own IS NOT NULL""",
        "time_budgets": """SELECT doc_id, pages, first_s, first_ocr_s, CASE WHEN retry > first_s THEN retry END AS retry_s FROM (SELECT *, least(900, 1800 - first_s, greatest(300, 2 * first_s)) AS retry
 FROM (SELECT doc_id, p AS pages, CASE WHEN 60 + 6 * p < 120 THEN 120 WHEN 60 + 6 * p > 900 THEN 900 ELSE 60 + 6 * p END AS first_s, CASE WHEN 60 + 12 * p < 120 THEN 120 WHEN 60 + 12 * p > 900 THEN 900 ELSE 60 + 12 * p END AS first_ocr_s
 FROM (SELECT doc_id, greatest(1, ceil(coalesce(n_chars, 0) / 20.0))::int AS p FROM documents)))""",
        "page_base": """WITH c AS (SELECT DISTINCT chunk_id, document_id, chunk_type, content_text, embedding_text FROM chunks),
 a AS (SELECT document_id, sum(length(content_text))::bigint AS chars, count(*) AS blocks, count(*) FILTER (chunk_type = 'table_row') AS tables FROM c WHERE content_text IS NOT NULL GROUP BY document_id),
 b AS (SELECT document_id, sum(length(embedding_text))::bigint AS chars, count(*) AS blocks, count(*) FILTER (chunk_type = 'table_row') AS tables FROM c WHERE embedding_text IS NOT NULL GROUP BY document_id)
SELECT document_id, a.chars + 40 * a.blocks + 220 * a.tables AS a_score, b.chars + 40 * b.blocks + 220 * b.tables AS b_score,
 CASE WHEN a.chars IS NULL OR (a.chars = 0 AND b.chars > 0) OR b.chars >= a.chars * 1.3 OR (b.chars + 40 * b.blocks + 220 * b.tables > a.chars + 40 * a.blocks + 220 * a.tables AND b.tables >= a.tables) THEN 'fallback' ELSE 'docling' END AS base FROM a FULL JOIN b USING (document_id)""",
        "table_compared": """WITH c AS (SELECT l_orderkey, l_linenumber AS row, unnest([0, 1]) AS col, unnest([l_returnflag, l_linestatus]) AS a, unnest([l_returnflag, CASE WHEN l_quantity > 45 THEN 'X' WHEN l_quantity > 40 THEN '' ELSE l_linestatus END]) AS b FROM lineitem),
 x AS (SELECT l_orderkey, row, col, max(a) AS a FROM c WHERE trim(a) <> '' GROUP BY ALL), y AS (SELECT l_orderkey, row, col, max(b) AS b FROM c WHERE trim(b) <> '' GROUP BY ALL)
SELECT decision, count(*) AS n_tables, sum(conflicts)::bigint AS n_conflicts FROM (SELECT CASE WHEN na = 0 OR nb = 0 THEN 'fallback_only' WHEN conflicts > 0 THEN 'conflict' WHEN same = na AND same = nb THEN 'duplicate' ELSE 'fallback_only' END AS decision, conflicts FROM (
 SELECT l_orderkey, count(a) AS na, count(b) AS nb, count(*) FILTER (a <> b) AS conflicts, count(*) FILTER (a = b) AS same FROM x FULL JOIN y USING (l_orderkey, row, col) GROUP BY l_orderkey)) GROUP BY decision""",
        "best_overlap": """SELECT l_orderkey, target_id, block_id, round(area, 6) AS area FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, target_id ORDER BY area DESC, block_id) AS k FROM (
 SELECT a.l_orderkey, a.l_linenumber AS target_id, b.l_linenumber AS block_id, greatest(0.0, least(a.l_quantity + 0.0 + 10.0, b.l_quantity + 1.0 + 10.0) - greatest(a.l_quantity + 0.0, b.l_quantity + 1.0)) * greatest(0.0, least(a.l_tax * 100 + 0.0 + 5.0, b.l_tax * 100 + 1.0 + 5.0) - greatest(a.l_tax * 100 + 0.0, b.l_tax * 100 + 1.0)) AS area
 FROM lineitem a JOIN lineitem b USING (l_orderkey)) WHERE area > 0) WHERE k = 1""",
        "words_in_box": """SELECT l_orderkey, box_id, string_agg(word, ' ' ORDER BY y, x0, ord, word) AS region_text FROM (SELECT b.l_orderkey, b.l_linenumber AS box_id, w.l_partkey::varchar AS word, w.l_linenumber AS ord, w.l_quantity AS x0, round_even(w.l_tax * 100, 1) AS y FROM lineitem b JOIN lineitem w USING (l_orderkey)
 WHERE w.l_quantity + 2 >= b.l_quantity + 0.5 - 2.0 AND w.l_quantity <= b.l_quantity + 0.5 + 10.0 + 2.0 AND w.l_tax * 100 + 1 >= b.l_tax * 100 + 0.5 - 2.0 AND w.l_tax * 100 <= b.l_tax * 100 + 0.5 + 5.0 + 2.0) GROUP BY l_orderkey, box_id""",
        "field_policy_cells": "SELECT * FROM (SELECT 'customer_email' AS column_name, 'internal_only' AS use, false AS answer_visible, count(*) AS n FROM customer UNION ALL SELECT 'Reference Link', 'reference_link', true, count(*) FROM customer UNION ALL SELECT 'internal_note', 'internal_only', false, count(*) FROM customer UNION ALL SELECT 'Segment', 'reference_link', true, count(*) FROM customer)",
        "reference_registry": r"""SELECT extraction_id AS node_id, 'ref_' || sha256(extraction_id || '|' || uri)[1:20] AS reference_id, max_by(raw, pos) AS raw_value, uri AS normalized_uri, 'url' AS reference_type, CASE WHEN host IN ('docs.plant7.example', 'docs.plant20.example') THEN 'trusted_remote' ELSE 'unverified_remote' END AS status, host IN ('docs.plant7.example', 'docs.plant20.example') AS answer_eligible, nullif(lower(regexp_extract(path, '[^/](\.[^./]+)$', 1)), '') AS file_extension
FROM (SELECT extraction_id, pos, raw, lower(regexp_extract(raw, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)', 1)) || '://' || lower(regexp_extract(raw, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)', 2)) || regexp_replace(regexp_extract(raw, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)', 3), ';[^/]*$', '') || regexp_extract(raw, '^[^?#]*(\?[^#]+)', 1) AS uri, lower(regexp_extract(raw, '^([a-zA-Z]+)://([^/?#]*)', 2)) AS host, regexp_replace(regexp_extract(raw, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)', 3), ';[^/]*$', '') AS path
 FROM (SELECT extraction_id, i AS pos, regexp_replace(f[i], '[.,;:)]+$', '') AS raw FROM (SELECT extraction_id, f, unnest(range(1, len(f) + 1)) AS i FROM (SELECT DISTINCT extraction_id, regexp_extract_all(markdown, '(?i)(?:https?://|file://)[^\s<>"]+') AS f FROM extraction_results WHERE markdown IS NOT NULL)))) GROUP BY extraction_id, uri, host, path""",
        "visual_assets": r"""SELECT extraction_id AS node_id, 'asset_' || sha256(extraction_id || '|' || i || '|' || f[i])[1:20] AS asset_id, 'png' AS asset_type, 'stored' AS status, f[i] AS locator FROM (SELECT extraction_id, f, unnest(range(1, len(f) + 1)) AS i FROM (SELECT DISTINCT extraction_id, regexp_extract_all(markdown, '!\[[^\]]*\]\(([^)]*)\)', 1) AS f FROM extraction_results WHERE markdown IS NOT NULL))""",
        "quality_issues": f"SELECT record_id, severity, code, count(*) AS n FROM ({_ISSUES}) GROUP BY ALL",
        "quality_status": f"SELECT record_id, coalesce(e, 0) = 0 AS is_valid, coalesce(e, 0) AS n_errors, coalesce(w, 0) AS n_warnings FROM (SELECT DISTINCT record_id FROM {_ISSUE_NODES}) LEFT JOIN (SELECT record_id, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w FROM ({_ISSUES}) GROUP BY record_id) USING (record_id)",
        "chunk_problems": """WITH c AS (SELECT DISTINCT chunk_id, content_text, parent_node_id, source_node_ids, metadata FROM chunks)
SELECT DISTINCT chunk_id, 'empty_text' AS code FROM c WHERE trim(coalesce(content_text, '')) = '' UNION SELECT chunk_id, 'missing_links' FROM c WHERE parent_node_id IS NULL OR len(coalesce(source_node_ids, [])) = 0
UNION SELECT chunk_id, 'missing_scope' FROM c WHERE metadata IS NULL OR json_extract(metadata, '$.security_scope') IS NULL UNION SELECT chunk_id, 'duplicate_id' FROM c GROUP BY chunk_id HAVING count(DISTINCT coalesce(content_text, chr(1))) > 1""",
        "chunk_statistics": "SELECT chunk_type, policy_version, count(*) AS n_chunks, max(length(content_text)) AS longest, sum(length(content_text))::bigint AS chars FROM (SELECT DISTINCT chunk_id, document_id, chunk_type, policy_version, content_text FROM chunks) GROUP BY ALL",
        "context_prefixes": "SELECT chunk_id, 'Document: ' || document_id || chr(10) || 'Context: ' || array_to_string(json_extract_string(metadata, '$.breadcrumbs[*]'), ' > ') || chr(10) || 'Content: ' AS prefix FROM (SELECT DISTINCT chunk_id, metadata, document_id FROM chunks) WHERE json_extract(metadata, '$.breadcrumbs') IS NOT NULL",
        "latest_versions": "SELECT document_id, source_version, artifact_id FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY regexp_extract(source_version, '^v(\\d+)$', 1)::int DESC, created_at DESC) AS k FROM canonical_artifacts) WHERE k = 1",
        "resolved_sources": """WITH l AS (SELECT document_id, source_hash AS h, processing_key AS p, artifact_status AS s, source_version AS v FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY regexp_extract(source_version, '^v(\\d+)$', 1)::int DESC, created_at DESC) AS k FROM canonical_artifacts) WHERE k = 1)
SELECT document_id, source_hash, processing_key, CASE WHEN source_hash = h AND processing_key = p AND s IN ('validated', 'ready') THEN 'reuse' ELSE 'create' END AS action, CASE WHEN source_hash = h AND processing_key = p AND s IN ('validated', 'ready') THEN v ELSE 'v' || (regexp_extract(v, '^v(\\d+)$', 1)::int + 1) END AS version FROM (SELECT DISTINCT document_id, source_hash, processing_key FROM canonical_artifacts) LEFT JOIN l USING (document_id)""",
        "intact_artifacts": "SELECT DISTINCT artifact_id, coalesce(starts_with(sha256(master_json), lower(regexp_replace(artifact_hash, '^sha256:', ''))) AND length(regexp_replace(artifact_hash, '^sha256:', '')) >= 32, false) AS is_intact FROM canonical_artifacts",
        "source_keys": f"SELECT doc_id, key, 'doc-' || key[1:24] AS document_id FROM (SELECT doc_id, sha256({fold(chr(99) + 'oalesce(agent_id, ' + repr('') + ')')} || '|text|' || {fold(chr(99) + 'oalesce(source_key, ' + repr('') + ')')}) AS key FROM documents)",
        "vector_topk": "SELECT query, vec_id, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query, e.vec_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 12) AS similarity FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0)) WHERE rank <= 10",
        "vector_validity": f"SELECT embedding_model, {_VALID} AS is_valid, count(*) AS n FROM (SELECT DISTINCT ON (chunk_id) * FROM embedded_chunks) GROUP BY ALL",
        "vector_payload": f"""SELECT chunk_id, embedding_model, document_id, agent_id, source_version, coalesce(json_extract_string(metadata, '$.security_scope.classification'), 'internal') AS classification, coalesce(array_to_string({_SCOPE}, '|'), '') AS allowed_groups, 'documents-' || replace(lower(agent_id), '_', '-') || '-chunks' AS collection
FROM (SELECT DISTINCT ON (chunk_id) * FROM chunks) JOIN (SELECT DISTINCT chunk_id, embedding_model FROM embedded_chunks WHERE {_VALID}) USING (chunk_id)""",
        "unknown_vectors": "SELECT DISTINCT chunk_id FROM embedded_chunks WHERE chunk_id IS NOT NULL AND chunk_id NOT IN (SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL)",
        "embedded_offline": f"SELECT chunk_id, 'hashed-32' AS embedding_model, 32 AS width FROM (SELECT DISTINCT chunk_id, embedding_text FROM chunks) WHERE {norm('embedding_text')} IS NOT NULL",
        "permitted_chunks": f"SELECT agent_id, count(*) AS n_chunks FROM (SELECT DISTINCT chunk_id, agent_id, metadata FROM chunks) WHERE list_has_any({_SCOPE}, ['grp-brake', 'grp-thermal']) GROUP BY agent_id",
        "bm25_topk": f"SELECT query_id, doc_id, round(score, 4) AS score FROM ({_bm25('documents', 'doc_id', 'text', 10)})",
        "rrf_fusion": f"SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (SELECT query_id, doc_id, round(sum(1.0 / (60 + rank)), 9) AS score FROM (SELECT query_id, doc_id, rank FROM ({_bm25('documents', 'doc_id', 'text', 20)}) UNION ALL SELECT query_id, doc_id, rank FROM ({_bm25('documents', 'doc_id', 'document_title', 20)})) GROUP BY ALL)) WHERE rank <= 10",
        "parent_expansion": f"SELECT DISTINCT a.chunk_id, b.chunk_id AS sibling_id FROM {_CHUNKS_ONCE} a JOIN (SELECT DISTINCT chunk_id FROM ({_bm25(_CHUNKS_ONCE, 'chunk_id', 'content_text', 10)})) f USING (chunk_id) JOIN {_CHUNKS_ONCE} b ON a.document_id = b.document_id AND a.parent_node_id = b.parent_node_id AND a.chunk_id <> b.chunk_id",
        "context_budget": f"SELECT * FROM (SELECT query_id, chunk_id, rank, sum(length(coalesce(content_text, ''))) OVER (PARTITION BY query_id ORDER BY rank ROWS UNBOUNDED PRECEDING)::bigint AS used_chars FROM ({_bm25(_CHUNKS_ONCE, 'chunk_id', 'content_text', 10)}) JOIN {_CHUNKS_ONCE} USING (chunk_id)) WHERE used_chars <= 4000",
        "source_labels": "SELECT CASE WHEN coalesce(policy_version = 'canonical-chunks-v2', false) THEN 'approved_source' WHEN chunk_type = 'table_row' THEN 'structured_data' ELSE 'supporting_text' END AS label, count(*) AS n FROM (SELECT DISTINCT chunk_id, chunk_type, policy_version FROM chunks) GROUP BY label",
        "intents": f"""WITH q AS (SELECT CASE WHEN item_id % 5 = 0 THEN 'Thank you very much' WHEN item_id % 5 = 1 THEN substr({norm('text')}, 1, 2) ELSE text END AS q FROM eval_items),
w AS (SELECT q, list_filter({tokens('q')}, lambda w: len(w) > 2 AND NOT list_contains(['what', 'about', 'the', 'this', 'that', 'these', 'those', 'and', 'how', 'why', 'its', 'one', 'ones', 'more', 'tell'], w)) AS w FROM q),
i AS (SELECT CASE WHEN q IS NULL THEN 'Domain_qn' WHEN q = 'Thank you very much' THEN 'general_chat' WHEN len(w) = 0 THEN 'clarification_qn' ELSE 'Domain_qn' END AS intent FROM w)
SELECT intent, CASE intent WHEN 'general_chat' THEN 'canned_reply' WHEN 'clarification_qn' THEN 'clarify' ELSE 'retrieve' END AS route, count(*) AS n FROM i GROUP BY ALL""",
        "canonical_nodes": _TREE + " SELECT artifact_id, ord, node_id, parent_ord, depth, node_type, n_children, blocked, page_number FROM t",
        "node_inspection": _TREE + " SELECT artifact_id, count(*) AS n_nodes, count(*) FILTER (blocked) AS n_blocked, max(depth) AS deepest, count(*) FILTER (node_type = 'page') AS pages, count(*) FILTER (node_type = 'slide') AS slides, count(*) FILTER (node_type = 'sheet') AS sheets, count(*) FILTER (node_type = 'table') AS tables FROM t GROUP BY artifact_id",
        "subtree_flags": _TREE + ", u AS (SELECT *, max(CASE WHEN depth = 0 THEN ord END) OVER (PARTITION BY artifact_id ORDER BY ord) AS top_ord FROM t) SELECT u.artifact_id, u.top_ord, h.node_id, count(*) FILTER (u.review) AS n_review FROM u JOIN t h ON h.artifact_id = u.artifact_id AND h.ord = u.top_ord GROUP BY ALL",
        "node_references": _TREE + ", x AS (SELECT artifact_id, ord, unnest(CAST(json_extract(v, '$.attributes.references') AS JSON[])) AS r, generate_subscripts(CAST(json_extract(v, '$.attributes.references') AS JSON[]), 1) - 1 AS at_no FROM t WHERE json_type(v, '$.attributes.references') = 'ARRAY') SELECT artifact_id, ord, at_no AS \"at\", json_extract_string(r, '$.reference_id') AS reference_id, json_extract_string(r, '$.status') AS status FROM x",
        "canonical_branches": _TREE + """, b AS (SELECT node_type, unnest(list_filter([CASE WHEN node_type IN ('table', 'table_header', 'table_row', 'table_cell', 'embedded_dataset') THEN 'sql' END,
 CASE WHEN node_type IN ('paragraph', 'text_block', 'bullet_block', 'title_block', 'note_block', 'guideline_block', 'reference_block', 'measurement_block', 'caption', 'table_row') THEN 'semantic' END,
 CASE WHEN node_type IN ('workbook', 'sheet', 'page', 'slide', 'section', 'region', 'table', 'image', 'embedded_dataset', 'form_section') THEN 'catalog' END,
 CASE WHEN node_type IN ('image', 'image_region', 'callout_label', 'ocr_block', 'caption') THEN 'visual' END], lambda x: x IS NOT NULL)) AS branch FROM t) SELECT branch, node_type, count(*) AS n FROM b GROUP BY ALL""",
        "export_elements": _ELEMENTS + " SELECT * FROM t",
        "missing_pages": _ELEMENTS + ", e AS (SELECT DISTINCT extraction_id AS record_id, unnest(range(1, page_count + 1)) AS page_no FROM extraction_results WHERE page_count >= 1) SELECT record_id, count(*) AS n_missing FROM e WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.record_id = e.record_id AND t.page_no = e.page_no) GROUP BY record_id",
        "suspicious_numbers": r"""SELECT chunk_id, regexp_matches(w, '(?i)\b(resistivity|conductivity|dielectric|thermal|expansion|coefficient|ohm|volume|surface)\b') AND NOT regexp_matches(w, '10\s*(\^|[⁰¹²³⁴⁵⁶⁷⁸⁹])') AND regexp_matches(w, '(^|[^0-9A-Za-z_])10[0-9]{3,}($|[^0-9A-Za-z_])') AS is_suspicious
FROM (SELECT DISTINCT chunk_id, CASE WHEN right(chunk_id, 1) < '8' THEN 'Volume of ' ELSE '' END || regexp_replace(content_text, '([0-9]+)', '10\1', 'g') AS w FROM chunks WHERE content_text IS NOT NULL)""",
        "hybrid_fusion": f"""WITH e AS (SELECT DISTINCT chunk_id, CAST(embedding AS DOUBLE[]) AS v FROM embedded_chunks WHERE embedding_model = 'dense-std-64' AND len(embedding) = dimensions AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT DISTINCT chunk_id AS query_id, content_text AS query_text, v FROM e JOIN chunks USING (chunk_id) WHERE content_text IS NOT NULL ORDER BY chunk_id LIMIT 3),
near AS (SELECT query_id, e.chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(s.v, e.v), 12) DESC, e.chunk_id) AS rank FROM s, e JOIN {_CHUNKS_ONCE} c ON c.chunk_id = e.chunk_id WHERE e.chunk_id <> query_id QUALIFY rank <= 20),
lex AS ({_bm25(_CHUNKS_ONCE, 'chunk_id', 'content_text', 20).replace(_SEARCHES, 's')}),
f AS (SELECT query_id, chunk_id, round(sum(1.0 / (60 + rank)), 9) AS score FROM (SELECT query_id, chunk_id, rank FROM near UNION ALL SELECT query_id, chunk_id, rank FROM lex) GROUP BY ALL)
SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM f QUALIFY rank <= 10""",
        "evidence_checks": f"""WITH f AS (SELECT * FROM ({_bm25(_CHUNKS_ONCE, 'chunk_id', 'content_text', 10)}) JOIN {_CHUNKS_ONCE} USING (chunk_id)),
v AS (SELECT query_id, chunk_id, parent_node_id, {values('content_text')} AS v FROM f),
c AS (SELECT DISTINCT a.query_id FROM v a JOIN v b ON a.query_id = b.query_id AND a.parent_node_id = b.parent_node_id AND a.chunk_id < b.chunk_id WHERE len(list_filter(a.v, lambda x: NOT list_contains(b.v, x))) > 0 AND len(list_filter(b.v, lambda x: NOT list_contains(a.v, x))) > 0)
SELECT query_id, count(*) AS n_evidence, max(score) AS best_score, round(max(score) / (1 + max(score)), 6) AS confidence, count(*) >= 3 AS is_sufficient, round(max(score) / (1 + max(score)), 6) >= 0.75 AS is_confident, query_id IN (SELECT query_id FROM c) AS has_conflict FROM f GROUP BY query_id""",
        "discovered_sources": f"""SELECT query_id, doc_id AS source_id, count(*) AS n_terms FROM (SELECT DISTINCT doc_id, unnest({tokens("coalesce(document_title, '')")}) AS token FROM documents) JOIN (SELECT DISTINCT query_id, unnest({tokens('query_text')}) AS token FROM {_SEARCHES}) USING (token) GROUP BY ALL""",
        "query_parts": """SELECT item_id AS query_id, p.part_no, CASE p.part_no WHEN 2 THEN item_id::varchar ELSE p.part_text END AS part_text, p.part_type FROM (SELECT DISTINCT item_id FROM eval_items WHERE text IS NOT NULL),
 (VALUES (0, 'How many parts leaked', 'aggregate'), (1, 'compare lot A-1 and lot B-2', 'comparison'), (2, '', 'lookup'), (3, 'why so', 'narrative')) p(part_no, part_text, part_type)""",
        "last_turns": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 4",
        "structured_aggregate": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, min(l_shipdate) AS first_ship, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
        "structured_filter": "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'R' AND l_discount >= 0.05",
        "structured_join": "SELECT r_name, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
        "structured_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
        "structured_page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 50",
        "guarded_statement": "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part WHERE p_size >= 10 GROUP BY p_brand",
        "sheet_regions": _CLASSIFIED,
        "sheet_classes": f"SELECT sheet_id, CASE WHEN count(DISTINCT classification) = 1 THEN min(classification) ELSE 'MIXED' END AS classification FROM ({_CLASSIFIED}) GROUP BY sheet_id",
        "row_texts": "SELECT s_suppkey, 's name is ' || s_name || '; s nationkey is ' || s_nationkey AS semantic_text FROM supplier",
        "cells_long": f"SELECT column_name, kind, count(*) AS n, min(value) AS least FROM (SELECT *, {_KIND} AS kind FROM {_CELLS}) GROUP BY ALL",
        "column_names": rf"""SELECT doc_id, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS column_name FROM (SELECT doc_id, base, row_number() OVER (PARTITION BY lang, base ORDER BY doc_id) AS k FROM (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(nullif(regexp_replace(regexp_replace(lower(coalesce({norm('document_title')}, 'column_' || doc_id)), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'column') AS base FROM documents))""",
        "activity_islands": "SELECT event_type, min(m) AS first, max(m) AS last, count(*) AS n FROM (SELECT event_type, m, m - row_number() OVER (PARTITION BY event_type ORDER BY m) AS g FROM (SELECT DISTINCT event_type, floor(epoch(date_trunc('second', ts)) / 60)::bigint AS m FROM events)) GROUP BY event_type, g",
        "hourly_events": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
        "event_sessions": "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)) GROUP BY user_id, s",
        "agent_collections": "SELECT agent_id, 'documents-' || replace(lower(agent_id), '_', '-') || '-chunks' AS collection, collection_name, regexp_full_match(agent_id, '[A-Za-z0-9][A-Za-z0-9._-]*') AS is_safe FROM agents",
    }
