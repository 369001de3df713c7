"""The subpackage's registered queries and, where SQL can express them, their equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import leaks, markup, mixing, neardup, neighbours, sentences, splitting
from lectern.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _oversized(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.oversized(table(spark, folder, "chunks"), table(spark, folder, "chunking_policies"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.units(table(spark, folder, "extraction_results"))


def p1_clean(spark: SparkSession, folder: str) -> DataFrame:
    return markup.clean(table(spark, folder, "extraction_results"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.oversized_keys(_oversized(spark, folder))


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.pieces(_oversized(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.similar_pairs(table(spark, folder, "chunks"))


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.groups(table(spark, folder, "chunks"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.close_pairs(table(spark, folder, "embedded_chunks"))


def p5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbours(table(spark, folder, "embedded_chunks"))


def p5_recall(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.recall(table(spark, folder, "embedded_chunks"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.exact_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p6_matches(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p6_documents(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked_documents(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.unreachable(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    sizes, solved = mixing.solve_exact(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    return mixing.mix(sizes, solved)


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    sizes, solved = mixing.solve_exact(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    return mixing.shares(mixing.mix(sizes, solved), solved)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentences(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p1_clean": p1_clean, "p2_found": p2_found, "p2_pieces": p2_pieces, "p4_found": p4_found, "p4_groups": p4_groups, "p5_found": p5_found, "p5_neighbours": p5_neighbours, "p5_recall": p5_recall, "p6_found": p6_found, "p6_matches": p6_matches, "p6_documents": p6_documents, "p7_found": p7_found, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": """
SELECT DISTINCT c.chunk_id
FROM chunks c JOIN chunking_policies p ON p.policy_version = coalesce(c.policy_version, 'canonical-chunks-v2')
WHERE length(c.content_text) > CASE WHEN c.chunk_type = 'table_row' THEN p.max_table_row_characters ELSE p.max_chunk_characters END""",
        "p4_found": r"""
WITH b AS (SELECT DISTINCT chunk_id, lower(coalesce(content_text, CASE WHEN contains(embedding_text, 'Content: ') THEN substr(embedding_text, strpos(embedding_text, 'Content: ') + 9) END)) AS body FROM chunks),
w AS (SELECT chunk_id, regexp_extract_all(body, '[\p{L}\p{N}]+') AS w FROM b),
s AS (SELECT DISTINCT chunk_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 3),
n AS (SELECT chunk_id, count(*) AS n FROM s GROUP BY chunk_id),
m AS (SELECT a.chunk_id AS a, b.chunk_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.s = b.s AND a.chunk_id < b.chunk_id GROUP BY ALL)
SELECT a AS chunk_id_a, b AS chunk_id_b FROM m JOIN n x ON x.chunk_id = a JOIN n y ON y.chunk_id = b WHERE 10 * both_have >= 7 * (x.n + y.n - both_have)""",
        "p5_found": r"""
WITH v AS (SELECT DISTINCT chunk_id, embedding_model, CAST(embedding AS DOUBLE[]) AS e FROM embedded_chunks
 WHERE len(embedding) = dimensions AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND embedding_model IS NOT NULL),
c AS (SELECT a.chunk_id AS a, b.chunk_id AS b, list_cosine_similarity(a.e, b.e) AS cos FROM v a JOIN v b ON a.embedding_model = b.embedding_model AND len(a.e) = len(b.e) AND a.chunk_id <> b.chunk_id),
r AS (SELECT a, b, cos, row_number() OVER (PARTITION BY a ORDER BY cos DESC, b) AS rank FROM c)
SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM r WHERE rank <= 10 AND cos >= 0.9""",
        "p7_found": r"""
WITH d AS (SELECT nullif(lower(trim(source)), '') AS source, sum(octet_length(encode(coalesce(text, '')))) AS size FROM documents GROUP BY 1),
t AS (SELECT lower(trim(source)) AS source, target_weight, max_repeats FROM mix_targets)
SELECT t.source FROM t LEFT JOIN d ON d.source = t.source WHERE max_repeats * coalesce(size, 0) < target_weight * (SELECT sum(size) FROM d WHERE source IS NOT NULL)""",
    }
