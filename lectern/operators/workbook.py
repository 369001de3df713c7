"""Sheets as long cell tables: regions, headers, tables and rows.

Cells: (sheet_id, row, col, value, kind) with ``value`` as text and ``kind`` its type (boolean, integer, float, string).
A region is a run of populated rows. Its class and header are judged on its first twelve rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T

SAMPLE_ROWS = 12


def cleaned(cells: DataFrame) -> DataFrame:
    """Cells with a value: blank ones and the placeholder 'None' are left out."""
    return cells.withColumn("value", T.without_placeholder("value")).where(F.col("value").isNotNull())


def regions(cells: DataFrame) -> DataFrame:
    """(sheet_id, region_no, first_row, last_row, max_col): runs of rows with at least one cell, numbered from 0."""
    rows = cells.where(F.col("sheet_id").isNotNull()).groupBy("sheet_id", "row").agg(F.max("col").alias("max_col"))
    w = Window.partitionBy("sheet_id").orderBy("row")
    runs = rows.withColumn("_run", F.col("row") - F.row_number().over(w)).groupBy("sheet_id", "_run").agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.max("max_col").alias("max_col"))
    numbered = runs.withColumn("region_no", F.row_number().over(Window.partitionBy("sheet_id").orderBy("first_row")) - 1)
    return numbered.select("sheet_id", "region_no", "first_row", "last_row", F.max("max_col").over(Window.partitionBy("sheet_id")).alias("max_col"))


def with_region(cells: DataFrame, found: DataFrame, sample: bool = False) -> DataFrame:
    """Cells with the region they lie in, of all rows or the first ``SAMPLE_ROWS``. Regions are spread over their rows, so the
    join is on sheet and row. It is a merge join: the size of a table file says little about the number of its regions, and a
    broadcast of them goes through the driver."""
    last = F.least("last_row", F.col("first_row") + SAMPLE_ROWS - 1) if sample else F.col("last_row")
    rows = found.withColumn("row", F.explode(F.sequence(F.col("first_row"), last)))
    return cells.join(rows.hint("merge"), ["sheet_id", "row"])


def classified(cells: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Regions with their class: IMAGE_HEAVY, STRUCTURED, MIXED or DOCUMENT_LIKE, and what it rests on.

    ``images`` (sheet_id, row) are anchors of pictures. Ratios are of the populated cells of the first twelve rows; the
    density divides those by all cells of the region.
    """
    found = regions(cells)
    placed = with_region(cells, found, sample=True)
    keys = ["sheet_id", "region_no", "first_row", "last_row", "max_col"]
    per_row = placed.groupBy(*keys, "row").agg(F.count("*").alias("n"), F.count_if(F.col("kind").isin("boolean", "integer", "float")).alias("numbers"), F.count_if((F.col("kind") == "string") & (F.char_length("value") > 24)).alias("long"))
    # Rows without a cell can't occur within a run; the first four rows decide on a table's shape.
    stats = per_row.groupBy(*keys).agg(F.sum("n").alias("populated"), F.sum("numbers").alias("numbers"), F.sum("long").alias("long"), F.max("n").alias("widest"), F.size(F.collect_set(F.when(F.col("row") < F.col("first_row") + 4, F.col("n")))).alias("shapes"))
    if images is not None:
        anchored = images.join(found, "sheet_id").where(F.col("row").between(F.col("first_row"), F.col("last_row"))).groupBy("sheet_id", "region_no").agg(F.count("*").alias("image_count"))
        stats = stats.join(anchored, ["sheet_id", "region_no"], "left").withColumn("image_count", F.coalesce("image_count", F.lit(0)))
    else:
        stats = stats.withColumn("image_count", F.lit(0).cast("bigint"))
    density = F.col("populated") / ((F.col("last_row") - F.col("first_row") + 1) * F.col("max_col"))
    numeric, text = F.col("numbers") / F.col("populated"), F.col("long") / F.col("populated")
    table_like = (F.col("widest") >= 3) & (F.col("shapes") <= 3)
    kind = F.when((F.col("image_count") > 0) & ((density < 0.08) | (F.col("populated") <= 2)), "IMAGE_HEAVY").when((numeric > 0.25) | table_like, F.when(text < 0.4, "STRUCTURED").otherwise("MIXED")).otherwise("DOCUMENT_LIKE")
    return stats.select("sheet_id", "region_no", "first_row", "last_row", T.cell_range(F.col("first_row"), F.lit(1), F.col("last_row"), F.col("max_col")).alias("cell_range"), kind.alias("classification"), "populated", F.round(density, 4).alias("density"), F.round(numeric, 4).alias("numeric_ratio"), "image_count")


def sheet_class(found: DataFrame) -> DataFrame:
    """(sheet_id, classification): the regions' single class, else MIXED."""
    return found.groupBy("sheet_id").agg(F.when(F.count_distinct("classification") == 1, F.min("classification")).otherwise("MIXED").alias("classification"))


def headed_regions(cells: DataFrame) -> DataFrame:
    """(sheet_id, region_no, first_row, last_row, header_row, title): regions with the first sampled row of at least two cells, half
    of them text; and the text of the first row above it (or of the first three where there is no header) that has exactly one cell."""
    placed = with_region(cells, regions(cells), sample=True)
    keys = ["sheet_id", "region_no", "first_row", "last_row"]
    rows = placed.groupBy(*keys, "row").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "string").alias("texts"), F.min_by("value", "col").alias("only"))
    is_header = (F.col("n") >= 2) & (F.col("texts") >= F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    headed = rows.withColumn("header_row", F.min(F.when(is_header, F.col("row"))).over(Window.partitionBy("sheet_id", "region_no")))
    titled = (F.col("n") == 1) & (F.col("row") < F.coalesce("header_row", F.col("first_row") + 3))
    return headed.groupBy(*keys).agg(F.min("header_row").alias("header_row"), F.min_by(T.normalised("only"), F.when(titled, F.col("row"))).alias("title"))


def headers(cells: DataFrame) -> DataFrame:
    """(sheet_id, region_no, header_row, title) of :func:`headed_regions`."""
    return headed_regions(cells).select("sheet_id", "region_no", "header_row", "title")


def column_names(labels: DataFrame, keys: list[str], position: str, label: str) -> DataFrame:
    """Adds column_name: sanitised, 'column_n' for a blank label, later ones of a name with _2, _3 and so on."""
    base = T.column_name(F.coalesce(T.normalised(label), F.concat(F.lit("column_"), F.col(position).cast("string"))))
    w = Window.partitionBy(*keys, "_base").orderBy(position)
    numbered = labels.withColumn("_base", base).withColumn("_n", F.row_number().over(w))
    return numbered.withColumn("column_name", F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat_ws("_", "_base", F.col("_n").cast("string")))).drop("_base", "_n")


def row_texts(cells: DataFrame, keys: list[str], position: str = "col") -> DataFrame:
    """(keys, semantic_text): 'column name is value; ...' of a row's cells (column_name, value) in order, without blank
    ones and formula errors."""
    shown = cells.where(T.normalised("value").isNotNull() & ~T.is_formula_error("value"))
    part = F.concat(F.replace(F.col("column_name"), F.lit("_"), F.lit(" ")), F.lit(" is "), F.col("value"))
    return shown.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), part.alias("t")))), lambda x: x["t"]), "; ").alias("semantic_text"))


def long_cells(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A wide table as cells: (keys, col, column_name, value, kind, unit). One generator, no shuffle."""
    cells = F.array(*[F.struct(F.lit(at).alias("col"), F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for at, name in enumerate(columns, 1)])
    return df.select(*keys, F.inline(cells)).withColumn("kind", T.value_type("value")).withColumn("unit", T.unit_of("value", "column_name"))


def nearby_text(cells: DataFrame, anchors: DataFrame, reach: int = 2, most: int = 1200) -> DataFrame:
    """(anchor_id, text): the rows around a picture's anchor (anchor_id, sheet_id, anchor_row), 'Row n: a | b'."""
    rows = cells.groupBy("sheet_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))), lambda x: x["value"]), " | ").alias("line"))
    near = anchors.join(rows, "sheet_id").where(F.col("row").between(F.col("anchor_row") - reach, F.col("anchor_row") + reach))
    told = near.groupBy("anchor_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", F.concat(F.lit("Row "), F.col("row").cast("string"), F.lit(": "), F.col("line")).alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return told.select("anchor_id", F.substring("text", 1, most).alias("text"))


def image_only_rows(images: DataFrame, cells: DataFrame) -> DataFrame:
    """(sheet_id, row_range): runs of picture rows that no region covers."""
    found = regions(cells)
    uncovered = images.select("sheet_id", "row").distinct().join(found.select("sheet_id", F.explode(F.sequence("first_row", "last_row")).alias("row")), ["sheet_id", "row"], "left_anti")
    w = Window.partitionBy("sheet_id").orderBy("row")
    runs = uncovered.withColumn("_run", F.col("row") - F.row_number().over(w)).groupBy("sheet_id", "_run").agg(F.min("row").alias("a"), F.max("row").alias("b"))
    return runs.select("sheet_id", T.row_range(F.col("a"), F.col("b")).alias("row_range"))


def notes(cells: DataFrame) -> DataFrame:
    """(sheet_id, row, note): the joined rows of regions that aren't structured, without their title and header rows."""
    kinds = classified(cells).select("sheet_id", "region_no", "classification")
    heads = headers(cells)
    placed = with_region(cells, regions(cells))
    joined = placed.groupBy("sheet_id", "region_no", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))), lambda x: x["value"]), " ").alias("note"))
    told = joined.join(kinds, ["sheet_id", "region_no"]).join(heads, ["sheet_id", "region_no"], "left")
    start = F.when(F.col("classification") == "DOCUMENT_LIKE", F.lit(0)).otherwise(F.coalesce(F.col("header_row") + 1, F.lit(0)))
    return told.where((F.col("classification") != "STRUCTURED") & (F.col("row") >= start) & ~F.col("note").eqNullSafe(F.col("title"))).select("sheet_id", "row", "note")


#: What a region of each class becomes (fixed values).
REGION_KINDS = {"STRUCTURED": "table", "MIXED": "section", "DOCUMENT_LIKE": "text_block", "IMAGE_HEAVY": "image_region"}


def region_kind(classification):
    out = F.lit("region")
    for name, kind in REGION_KINDS.items():
        out = F.when(classification == name, kind).otherwise(out)
    return out


def used_range(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """(sheet_id, used_range): the A1 range of a sheet's cells from its first to its last; null for a sheet without any."""
    edges = cells.groupBy("sheet_id").agg(F.min("row").alias("r"), F.min("col").alias("c"), F.max("row").alias("rr"), F.max("col").alias("cc"))
    return sheets.select("sheet_id").distinct().join(edges, "sheet_id", "left").select("sheet_id", T.cell_range(F.col("r"), F.col("c"), F.col("rr"), F.col("cc")).alias("used_range"))


def sheet_classes(found: DataFrame, sheets: DataFrame) -> DataFrame:
    """(sheet_id, classification) of every sheet; one without a region is UNKNOWN."""
    return sheets.select("sheet_id").distinct().join(sheet_class(found), "sheet_id", "left").select("sheet_id", F.coalesce("classification", F.lit("UNKNOWN")).alias("classification"))


def anchor_range(first_row, first_col, last_row, last_col):
    """The A1 range of a picture's anchor, whose marks count from 0; without an end it is one cell; null without a start."""
    end = lambda end, start: F.greatest(F.coalesce(end, start), start) + 1
    return T.cell_range(first_row + 1, first_col + 1, end(last_row, first_row), end(last_col, first_col))


def table_rows(cells: DataFrame) -> DataFrame:
    """(sheet_id, region_no, table_name, row, col, column_name, value, kind, unit): the cells below each region's header row as
    rows of a table with named columns; blank rows are skipped. A table is named after its title, else after its region."""
    cells = cells.select("sheet_id", "row", "col", "value", "kind")
    placed = with_region(cells, headed_regions(cells).where(F.col("header_row").isNotNull()))
    labels = placed.where(F.col("row") == F.col("header_row"))
    named = column_names(labels.select("sheet_id", "region_no", "col", "value"), ["sheet_id", "region_no"], "col", "value").select("sheet_id", "region_no", "col", "column_name")
    below = placed.where(F.col("row") > F.col("header_row")).join(named.hint("merge"), ["sheet_id", "region_no", "col"], "left")
    name = F.coalesce("column_name", F.concat(F.lit("column_"), F.col("col").cast("string")))
    title = F.coalesce(F.when(F.col("title").isNotNull(), T.column_name("title")), F.concat(F.lit("table_"), (F.col("region_no") + 1).cast("string")))
    return below.select("sheet_id", "region_no", title.alias("table_name"), "row", "col", name.alias("column_name"), "value", "kind", T.unit_of("value", name).alias("unit"))


def tree(workbook_id: str, cells: DataFrame) -> DataFrame:
    """The nodes of a workbook: (workbook_id, node_id, parent_id, node_type, title, text, cell_range): workbook, sheets, regions,
    and for regions with a header table, rows and cells. Ids are hashes of the place, so they stay the same from run to run."""
    book = T.short_hash("wb_", 16, F.lit(workbook_id))
    ident = lambda kind, *parts: T.short_hash(kind, 16, F.lit(workbook_id), *parts)
    none = F.lit(None).cast("string")

    def node(df, own, parent, kind, title=none, text=none, where=none):
        return df.select(F.lit(workbook_id).alias("workbook_id"), own.alias("node_id"), parent.alias("parent_id"), kind.alias("node_type"), title.alias("title"), text.alias("text"), where.alias("cell_range"))

    sheet, region = ident("sh_", "sheet_id"), ident("rg_", "sheet_id", "region_no")
    table, row = ident("tb_", "sheet_id", "region_no"), ident("rw_", "sheet_id", "row")
    sheets, found, data = cells.select("sheet_id").distinct(), classified(cells), table_rows(cells)
    named = data.select("sheet_id", "region_no", "table_name").distinct()
    rows = data.groupBy("sheet_id", "region_no", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", F.concat("column_name", F.lit(": "), "value").alias("t")))), lambda x: x["t"]), " | ").alias("text"), F.min("col").alias("c"), F.max("col").alias("cc"))
    parts = [
        node(sheets.limit(1), book, none, F.lit("workbook"), F.lit(workbook_id)),
        node(sheets, sheet, book, F.lit("sheet"), F.col("sheet_id").cast("string")),
        node(found, region, sheet, F.lit("region"), F.col("classification"), none, F.col("cell_range")),
        node(named, table, region, F.lit("table"), F.col("table_name")),
        node(rows, row, table, F.lit("table_row"), none, F.col("text"), T.cell_range(F.col("row"), F.col("c"), F.col("row"), F.col("cc"))),
        node(data, ident("cl_", "sheet_id", "row", "col"), row, F.lit("table_cell"), F.col("column_name"), F.col("value"), T.cell_range(F.col("row"), F.col("col"), F.col("row"), F.col("col"))),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def warnings(cells: DataFrame, hidden: DataFrame | None = None) -> DataFrame:
    """(sheet_id, code, n): formula errors, formulas without a value and, with ``hidden`` (sheet_id, rows, columns), hidden rows and
    columns, counted per sheet; only what occurs."""
    value = F.col("value")
    counted = cells.groupBy("sheet_id").agg(F.count_if(T.is_formula_error(value)).alias("formula_errors"), F.count_if(T.is_formula(value)).alias("formulas"))
    names = ["formula_errors", "formulas"]
    if hidden is not None:
        counted = counted.join(hidden.groupBy("sheet_id").agg(F.sum("rows").alias("hidden_rows"), F.sum("columns").alias("hidden_columns")), "sheet_id", "left")
        names += ["hidden_rows", "hidden_columns"]
    stacked = F.array(*[F.struct(F.lit(n).alias("code"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n")) for n in names])
    return counted.select("sheet_id", F.inline(stacked)).where("n > 0")


def with_formula_flags(cells: DataFrame) -> DataFrame:
    """Cells with formula_error and retrieval_allowed: a cell that holds an error isn't retrieved."""
    return cells.withColumn("formula_error", T.is_formula_error("value")).withColumn("retrieval_allowed", ~T.is_formula_error("value"))


def value_sets(cells: DataFrame) -> DataFrame:
    """(sheet_id, column_name, units, kinds): the distinct units and value types of each named column, sorted."""
    data = table_rows(cells)
    return data.groupBy("sheet_id", "column_name").agg(F.array_sort(F.collect_set("unit")).alias("units"), F.array_sort(F.collect_set("kind")).alias("kinds"))


def image_nodes(images: DataFrame, cells: DataFrame) -> DataFrame:
    """(sheet_id, image_id, cell_range, region_no, classification, confidence): pictures (sheet_id, image_id, row, col, last_row,
    last_col, counted from 0) with the region they stand in; 0.82 sure where there is one, else 0.68 (fixed values)."""
    found = classified(cells).withColumn("_row", F.explode(F.sequence("first_row", "last_row"))).select("sheet_id", "_row", "region_no", "classification")
    placed = images.withColumn("_row", (F.col("row") + 1).cast("int")).join(found, ["sheet_id", "_row"], "left")
    return placed.select("sheet_id", "image_id", anchor_range(F.col("row"), F.col("col"), F.col("last_row"), F.col("last_col")).alias("cell_range"), "region_no", "classification", F.when(F.col("region_no").isNotNull(), 0.82).otherwise(0.68).alias("confidence"))
