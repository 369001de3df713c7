"""Text lines to ordered node tables, sections, branches and multiset comparisons, all as DataFrame plans.

Rows with null keys or texts have no nodes. Windows are over one document's lines; documents spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T

LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# Node types by branch.
SQL_TYPES = ("table", "table_header", "table_row", "table_cell", "embedded_dataset")
SEMANTIC_TYPES = ("paragraph", "text_block", "bullet_block", "title_block", "note_block", "guideline_block", "reference_block", "measurement_block", "caption", "table_row")
CATALOG_TYPES = ("workbook", "sheet", "page", "slide", "section", "region", "table", "image", "embedded_dataset", "form_section")
VISUAL_TYPES = ("image", "image_region", "callout_label", "ocr_block", "caption")
NARRATIVE_TYPES = ("paragraph", "text_block", "bullet_block", "title_block", "note_block", "guideline_block", "reference_block", "measurement_block", "label_value_block", "status_block", "caption")


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line): the non-blank lines, stripped of outer blanks, numbered from 0 over all lines."""
    split = df.select(F.col(key), F.posexplode(F.split(F.col(text), LINE_END)).alias("line_no", "line"))
    strip = F.regexp_replace("line", f"^{T.BLANK}+|{T.BLANK}+$", "")
    return split.select(key, "line_no", strip.alias("line")).where("line <> ''")


#: Parts nodes within a row while they are put together; a line end, so no line holds it.
_SEAM = "\x1e"


def lines_to_nodes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, node_no, node_type, text): headings and bullets are nodes of their own, lines between them one paragraph.

    Everything happens within the row, in the JVM and without a shuffle: lines are typed, joined with a seam wherever a node
    begins, and cut at the seams.
    """

    def typed(line: Column) -> Column:
        return F.struct(F.when(T.is_heading(line, True), "t").when(T.is_bullet(line, True), "b").otherwise("p").alias("k"), line.alias("line"))

    def joined(lines: Column) -> Column:
        goes_on = lambda x, at: (x["k"] == "p") & (at > 0) & (F.get(lines, at - 1)["k"] == "p")
        return F.array_join(F.transform(lines, lambda x, at: F.concat(F.when(goes_on(x, at), " ").otherwise(F.concat(F.lit(_SEAM), x["k"])), x["line"])), "")

    def node(part: Column) -> Column:
        kind, body = F.substring(part, 1, 1), F.substring(part, 2, 2_147_483_647)
        own = F.when(kind == "t", T.heading_text(body)).when(kind == "b", T.bullet_text(body)).otherwise(body)
        return F.struct(F.when(kind == "t", "title_block").when(kind == "b", "bullet_block").otherwise("paragraph").alias("node_type"), own.alias("text"))

    lines = F.transform(F.filter(F.transform(F.split(F.col(text), LINE_END), T.squeezed), lambda x: x != ""), typed)
    parts = F.filter(F.split(T.bound(lines, joined), _SEAM), lambda x: x != "")
    nodes = F.filter(F.transform(parts, node), lambda n: n["text"].isNotNull())
    return df.select(F.col(key), F.posexplode(nodes).alias("node_no", "_n")).select(key, "node_no", "_n.node_type", "_n.text")


def with_sections(nodes: DataFrame, key: str) -> DataFrame:
    """Adds section_no and section_title: each node belongs to the last heading before it (0 and null before the first)."""
    order = Window.partitionBy(key).orderBy("node_no").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.col("node_type") == "title_block"
    return nodes.withColumn("section_no", F.sum(heading.cast("int")).over(order)).withColumn("section_title", F.last(F.when(heading, F.col("text")), ignorenulls=True).over(order))


def markdown_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section_no, section): a text cut before each line that starts with '#'; blank sections are left out."""
    split = df.select(F.col(key), F.posexplode(F.split(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), "\n")).alias("line_no", "line"))
    order = Window.partitionBy(key).orderBy("line_no")
    cut = split.withColumn("part", F.sum((F.startswith("line", F.lit("#")) & (F.col("line_no") > 0)).cast("int")).over(order))
    joined = cut.groupBy(key, "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("section"))
    kept = joined.where(T.normalised("section").isNotNull())
    return kept.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("part")) - 1).alias("section_no"), F.regexp_replace("section", f"^{T.BLANK}+|{T.BLANK}+$", "").alias("section"))


def markdown_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, block_no, block): a text cut at blank lines; block_no counts all blocks, blank ones are left out."""
    split = df.select(F.col(key), F.posexplode(F.split(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), "\n\n")).alias("block_no", "block"))
    return split.where(T.normalised("block").isNotNull()).select(key, "block_no", F.regexp_replace("block", f"^{T.BLANK}+|{T.BLANK}+$", "").alias("block"))


def branches(nodes: DataFrame, kind: str = "node_type") -> DataFrame:
    """One row per node and branch it belongs to (sql, semantic, catalog, visual), in a single pass over the nodes."""
    named = (("sql", SQL_TYPES), ("semantic", SEMANTIC_TYPES), ("catalog", CATALOG_TYPES), ("visual", VISUAL_TYPES))
    found = F.array_compact(F.array(*[F.when(F.col(kind).isin(*types), F.lit(name)) for name, types in named]))
    return nodes.withColumn("branch", F.explode(found))


def token_counts(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, token, n): token multiset of each group, or of everything."""
    return df.select(*keys, F.explode(T.tokens(text)).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))


def missing_tokens(source: DataFrame, rendered: DataFrame, text_a: str, text_b: str, top: int = 20) -> DataFrame:
    """The ``top`` tokens of ``source`` that ``rendered`` lacks, as multisets, with how many: (token, missing)."""
    a = token_counts(source, text_a).withColumnRenamed("n", "have")
    b = token_counts(rendered, text_b).withColumnRenamed("n", "kept")
    gone = a.join(b, "token", "left").select("token", (F.col("have") - F.coalesce("kept", F.lit(0))).alias("missing"))
    return gone.where("missing > 0").orderBy(F.desc("missing"), "token").limit(top)


def coverage_by_key(a: DataFrame, b: DataFrame, key: str, text_a: str, text_b: str) -> DataFrame:
    """(key, covered, total, share): the tokens of ``a`` that ``b`` holds, as multisets, per key; a shuffle on (key, token)."""
    x = token_counts(a, text_a, key)
    y = token_counts(b, text_b, key).withColumnRenamed("n", "m")
    joined = x.join(y, [key, "token"], "left")
    return joined.groupBy(key).agg(F.sum(F.least("n", F.coalesce("m", F.lit(0)))).alias("covered"), F.sum("n").alias("total")).withColumn("share", F.round(F.col("covered") / F.col("total"), 4))


def islands(df: DataFrame, group: list[str], position: str) -> DataFrame:
    """(group, first, last, n): runs of positions without a gap; repeated positions count once."""
    once = df.select(*group, F.col(position).alias("_p")).distinct()
    w = Window.partitionBy(*group).orderBy("_p")
    keyed = once.withColumn("_island", F.col("_p") - F.row_number().over(w))
    return keyed.groupBy(*group, "_island").agg(F.min("_p").alias("first"), F.max("_p").alias("last"), F.count("*").alias("n")).drop("_island")


def repeats(df: DataFrame, key: Column, order: list[Column | str]) -> DataFrame:
    """The second and later rows of each key, with occurrence number; null keys repeat nothing. A key's rows are ranked by one
    task, streaming; rows are cut to what the caller selects before, so a hot key costs keys and order columns only."""
    return df.where(key.isNotNull()).withColumn("occurrence", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("occurrence > 1")
