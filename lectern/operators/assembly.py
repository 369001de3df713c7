"""Extracted pages, tables and elements put together to canonical nodes.

Extractors give elements (text, type, box), tables (cells or matrices) and exported layout trees. What they have in common
becomes one node table: (document_id, part_no, ord, node_type, level, text, row, col, ...). Exported trees are flattened by
:mod:`lectern.operators.nested`; order and references are joins and windows on its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T

#: Element classes by what their names contain (fixed values); the first match wins.
ELEMENT_KINDS = (("head", "heading"), ("title", "heading"), ("list", "list_item"), ("table", "table"), ("picture", "image"), ("image", "image"), ("figure", "image"))
#: Node types of extracted blocks (fixed values).
BLOCK_TYPES = {"title": "title_block", "heading": "title_block", "bullet": "bullet_block", "list_item": "bullet_block", "notes": "note_block", "caption": "caption", "image": "image", "cell": "table_cell"}


def element_kind(name: Column) -> Column:
    """heading, list_item, table, image or paragraph of an element's class name."""
    low = F.lower(F.coalesce(name, F.lit("")))
    out = F.lit("paragraph")
    for part, kind in reversed(ELEMENT_KINDS):
        out = F.when(F.contains(low, F.lit(part)), kind).otherwise(out)
    return out


def element_text(*candidates: Column) -> Column:
    """The first candidate that isn't blank, as it stands."""
    return F.coalesce(*[F.when(T.normalised(c).isNotNull(), c) for c in candidates])


def block_type(kind: Column) -> Column:
    out = F.lit("paragraph")
    for name, made in BLOCK_TYPES.items():
        out = F.when(kind == name, made).otherwise(out)
    return out


def export_elements(tagged: DataFrame) -> DataFrame:
    """(record_id, ord, self_ref, parent_ref, label, title, text, page_no, left, top): the elements of exported layout trees, from the
    tagged rows of :func:`lectern.operators.nested.emit_tagged` (a node's row and the first of its ``prov`` rows, whose ``bbox`` is
    a row of its own). Pages below 1 are none."""
    once = tagged.dropDuplicates(["record_kind", "record_id", "row_no"])
    fields = F.from_json("payload", "label string, title string, text string, content string, value string")
    own = once.where(F.col("tag") == "node").select("record_id", F.col("row_no").alias("ord"), F.col("id").alias("self_ref"), "parent_id", fields.alias("f"))
    prov = once.where((F.col("field") == "prov") & (F.col("position") == 0)).select("record_id", F.col("parent_row").alias("ord"), F.col("row_no").alias("prov_row"), F.from_json("payload", "page_no string").alias("p"))
    bbox = once.where(F.col("field") == "bbox").select("record_id", F.col("parent_row").alias("prov_row"), F.from_json("payload", "l double, t double, r double, b double").alias("b"))
    placed = own.join(prov, ["record_id", "ord"], "left").join(bbox, ["record_id", "prov_row"], "left")
    page = F.expr("try_cast(p.page_no AS int)")
    low = lambda a, b: F.least(F.col(f"b.{a}"), F.coalesce(f"b.{b}", f"b.{a}"))
    return placed.select("record_id", "ord", "self_ref", F.col("parent_id").alias("parent_ref"), F.col("f.label").alias("label"), T.normalised("f.title").alias("title"), element_text(F.col("f.text"), F.col("f.content"), F.col("f.value")).alias("text"), F.when(page >= 1, page).alias("page_no"), low("l", "r").alias("left"), low("t", "b").alias("top"))


def resolved_references(elements: DataFrame) -> DataFrame:
    """Elements in the order in which references from their parents reach them, each once: the first place of a self_ref counts, a
    repeated one is a reference back and gets no row. A join-free form of following references with a visited set."""
    first = Window.partitionBy("record_id", "self_ref").orderBy("ord")
    return elements.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n").withColumn("place", F.row_number().over(Window.partitionBy("record_id").orderBy("ord")) - 1)


def export_pages(elements: DataFrame) -> DataFrame:
    """(record_id, page_no, n_blocks, n_tables, n_images, chars, text): the pages of exported trees, with their texts in order."""
    kind = element_kind(F.col("label"))
    texts = F.array_sort(F.collect_list(F.when(T.normalised("text").isNotNull(), F.struct("ord", "text"))))
    paged = elements.where(F.col("page_no").isNotNull()).groupBy("record_id", "page_no").agg(F.count_if(F.col("text").isNotNull()).alias("n_blocks"), F.count_if(kind == "table").alias("n_tables"), F.count_if(kind == "image").alias("n_images"), F.sum(F.coalesce(F.char_length("text"), F.lit(0))).alias("chars"), texts.alias("_t"))
    return paged.select("record_id", "page_no", "n_blocks", "n_tables", "n_images", "chars", F.array_join(F.transform("_t", lambda x: x["text"]), "\n").alias("text"))


def text_fragments(tagged: DataFrame) -> DataFrame:
    """(record_id, ord, text): every ``text`` value at any depth of the flattened records, in document order; blank ones are none."""
    found = tagged.dropDuplicates(["record_kind", "record_id", "row_no"]).select("record_id", F.col("row_no").alias("ord"), F.get_json_object("payload", "$.text").alias("text"))
    return found.where(T.normalised("text").isNotNull())


def matrix(value: Column) -> Column:
    """A table's JSON as a matrix of texts: a list of lists as it is, a list of objects with their names as the first row; null for
    anything else and for tables without a row."""
    lists = F.from_json(value, "array<array<string>>")
    objects = F.from_json(value, "array<map<string,string>>")
    names = F.array_distinct(F.flatten(F.transform(objects, F.map_keys)))
    from_objects = F.concat(F.array(names), F.transform(objects, lambda o: F.transform(names, lambda n: F.coalesce(o[n], F.lit("")))))
    is_objects = F.startswith(F.regexp_replace(value, r"^\s*\[\s*", ""), F.lit("{"))
    made = F.when(is_objects, from_objects).otherwise(F.transform(lists, lambda row: F.transform(row, lambda c: F.coalesce(c, F.lit("")))))
    return F.when(F.size(made) > 0, made)


def matrix_nodes(tables: DataFrame, key: str, column: str) -> DataFrame:
    """(key, node_type, row, col, column_name, text): a matrix's first row is its header, the others are rows of cells; a cell is
    named after its column. Blank cells are left out, rows without a cell too."""
    rows = tables.where(F.col(column).isNotNull()).select(key, F.get(column, F.lit(0)).alias("_head"), F.posexplode(F.slice(column, 2, 1_000_000_000)).alias("_row", "_cells"))
    head = tables.where(F.col(column).isNotNull()).select(key, F.lit("table_header").alias("node_type"), F.lit(0).alias("row"), F.lit(None).cast("int").alias("col"), F.lit(None).cast("string").alias("column_name"), F.array_join(F.get(column, F.lit(0)), " | ").alias("text"))
    cells = rows.select(key, (F.col("_row") + 1).alias("row"), "_head", F.posexplode("_cells").alias("_col", "text")).where(T.normalised("text").isNotNull())
    name = F.coalesce(T.normalised(F.get("_head", F.col("_col"))), F.concat(F.lit("column_"), (F.col("_col") + 1).cast("string")))
    made = cells.select(key, F.lit("table_cell").alias("node_type"), "row", (F.col("_col") + 1).alias("col"), name.alias("column_name"), T.normalised("text").alias("text"))
    joined = made.groupBy(key, "row").agg(F.array_sort(F.collect_list(F.struct("col", F.concat("column_name", F.lit(": "), "text").alias("t")))).alias("_x"))
    whole = joined.select(key, F.lit("table_row").alias("node_type"), "row", F.lit(None).cast("int").alias("col"), F.lit(None).cast("string").alias("column_name"), F.array_join(F.transform("_x", lambda x: x["t"]), " | ").alias("text"))
    return head.unionByName(whole).unionByName(made)


def structured_cell_nodes(cells: DataFrame, key: str) -> DataFrame:
    """(key, row, text, n_cells, is_header): structured cells (key, row, col, text, column_header), one row each; spans aren't
    spread and header rows stay rows. Cells that lie outside their table should be filtered before (quality.cell_is_readable)."""
    own = cells.withColumn("_t", T.normalised("text"))
    grouped = own.groupBy(key, "row").agg(F.array_sort(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("col", "_t")))).alias("_x"), F.count("*").alias("n_cells"), F.coalesce(F.bool_and("column_header"), F.lit(False)).alias("is_header"))
    return grouped.select(key, "row", F.array_join(F.transform("_x", lambda x: x["_t"]), " | ").alias("text"), "n_cells", "is_header")


def block_nodes(blocks: DataFrame) -> DataFrame:
    """(path, part, ord, node_id, parent_id, node_type, level, text, row, col, section_title): the blocks of office files
    (``sources.office.BLOCKS``) as nodes in order, below the page, slide or sheet they stand on; each node has the last heading
    before it in its file. Errors and warnings of the reader are no nodes."""
    own = blocks.where(~F.col("kind").isin("error", "warning"))
    part_type = F.when(F.col("source_type") == "xlsx", "sheet").when(F.col("source_type") == "pptx", "slide").otherwise("section")
    parent = T.short_hash("pt_", 16, "path", "part")
    heads = own.groupBy("path", "part").agg(F.min("ord").alias("ord"), F.first(part_type).alias("node_type"), F.min(F.when(F.col("kind").isin("sheet", "title"), F.col("text"))).alias("text"))
    none = lambda t: F.lit(None).cast(t)
    tops = heads.select("path", "part", F.col("ord"), parent.alias("node_id"), none("string").alias("parent_id"), "node_type", none("int").alias("level"), "text", none("int").alias("row"), none("int").alias("col"), none("string").alias("section_title"))
    order = Window.partitionBy("path").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("kind").isin("heading", "title"), F.col("text"))
    inner = own.where(F.col("kind") != "sheet").withColumn("section_title", F.last(heading, ignorenulls=True).over(order))
    kind = F.when(F.col("kind") == "heading", F.lit("title_block")).otherwise(block_type(F.col("kind")))
    return tops.unionByName(inner.select("path", "part", "ord", T.short_hash("nd_", 16, "path", "ord").alias("node_id"), parent.alias("parent_id"), kind.alias("node_type"), "level", "text", "row", "col", "section_title"))
