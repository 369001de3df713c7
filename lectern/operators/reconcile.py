"""Reconciling two extractions of the same pages.

Pages meet in a full outer join; scores choose the base; blocks, tables and images of the other side are compared with it.
Only the merge of a page's text is a fold (each accepted block extends what the next one is compared with): that runs per
page in ``applyInPandas``; everything else is declarative.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import compare
from lectern.functions import text as T

# Outcomes that a summary counts, and the gain in text that makes the other side the base.
OUTCOMES = ("selected_docling", "selected_fallback", "duplicate", "near_duplicate", "fallback_only", "conflict", "conflict_resolved")
TEXT_GAIN = 1.3

def pair_pages(primary: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of scored pages (keys, chars, score, n_tables) with the chosen base: (…, base) is 'docling' or
    'fallback'. The other side wins with clearly more text, or a higher score and at least as many tables."""
    a = primary.select(*keys, *[F.col(c).alias(f"a_{c}") for c in ("chars", "score", "n_tables")])
    b = other.select(*keys, *[F.col(c).alias(f"b_{c}") for c in ("chars", "score", "n_tables")])
    joined = a.join(b, keys, "full_outer")
    gain = ((F.col("a_chars") == 0) & (F.col("b_chars") > 0)) | (F.col("b_chars") >= F.col("a_chars") * TEXT_GAIN)
    structure = (F.col("b_score") > F.col("a_score")) & (F.col("b_n_tables") >= F.col("a_n_tables"))
    return joined.withColumn("base", F.when(F.col("a_score").isNull() | gain | structure, "fallback").otherwise("docling"))


def outcome_summary(events: DataFrame, keys: list[str], decision: str = "decision") -> DataFrame:
    """Counts of the fixed outcomes per key, zeros included; other decisions aren't counted."""
    return events.groupBy(*keys).agg(*[F.count_if(F.col(decision) == name).alias(name) for name in OUTCOMES])


def merge_page_text(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The fold over a page's blocks: columns (keys, base_text, block_no, block_text) to (keys, block_no, decision, accepted).

    Blocks that bring something new (fallback_only or conflict) are accepted and extend what later ones are compared with; the
    counts of that text are kept, so a page costs what its blocks hold. A page's blocks are one group; pages spread over all
    tasks.
    """

    def fold(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values("block_no")
        known, out = compare.Known(page["base_text"].iloc[0]), []
        for text in page["block_text"]:
            block = compare.measured(text or "")
            made = known.decide(block)
            accepted = made in ("fallback_only", "conflict")
            if accepted:
                known.add(block)
            out.append((made, accepted))
        return page[[*keys, "block_no"]].assign(decision=[d for d, _ in out], accepted=[a for _, a in out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields if f.name in (*keys, "block_no"))
    return blocks.groupBy(*keys).applyInPandas(fold, f"{fields}, decision string, accepted boolean")


def arbitrated(decisions: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Conflicts settled by the page's raw words: ``decisions`` (keys, block_no, decision, base_text, block_text, box_id) with the
    text that stands in each box (``regions``: keys, box_id, region_text, as :func:`words_in_box` gives it). Where exactly one
    side's tokens stand there, the decision becomes conflict_resolved, with the winner 'A' (base) or 'B' (block)."""
    joined = decisions.join(regions.select(*keys, "box_id", "region_text"), [*keys, "box_id"], "left")
    won = F.when(F.col("decision") == "conflict", winner(F.coalesce("region_text", F.lit("")), F.col("base_text"), F.col("block_text")))
    return joined.withColumn("winner", won).withColumn("decision", F.when(F.col("winner").isNotNull(), "conflict_resolved").otherwise(F.col("decision"))).drop("region_text")


def compare_cells(primary: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Tables as cells (keys, row, col, text): (keys, decision, conflicts). Cells with blank text don't count; of cells
    that share a coordinate the greatest text does.

    conflict: a shared coordinate differs; duplicate: all cells agree both ways; else fallback_only.
    """
    clean = lambda df, name: df.select(*keys, "row", "col", T.normalised("text").alias("_t")).where(F.col("_t").isNotNull()).groupBy(*keys, "row", "col").agg(F.max("_t").alias(name))
    joined = clean(primary, "a").join(clean(other, "b"), [*keys, "row", "col"], "full_outer")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    counted = joined.groupBy(*keys).agg(F.count("a").alias("na"), F.count("b").alias("nb"), F.count_if(both & (F.col("a") != F.col("b"))).alias("conflicts"), F.count_if(both & (F.col("a") == F.col("b"))).alias("same"))
    decision = F.when((F.col("na") == 0) | (F.col("nb") == 0), "fallback_only").when(F.col("conflicts") > 0, "conflict").when((F.col("same") == F.col("na")) & (F.col("same") == F.col("nb")), "duplicate").otherwise("fallback_only")
    return counted.select(*keys, decision.alias("decision"), "conflicts")


def best_table_decision(decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Of the decisions of one table against all of a page: duplicate before conflict before fallback_only."""
    rank = F.when(F.col("decision") == "duplicate", 0).when(F.col("decision") == "conflict", 1).otherwise(2)
    return decisions.groupBy(*keys).agg(F.min_by("decision", rank).alias("decision"))


def words_in_box(words: DataFrame, boxes: DataFrame, keys: list[str], tolerance: float = 2.0) -> DataFrame:
    """(keys, box_id, region_text): the words (x0, y0, x1, y1, word, ord) that touch a box (box_id, left, top, width, height),
    grown by ``tolerance``, in reading order. An equi join on the page with the overlap as its remaining condition."""
    b = boxes.select(*keys, "box_id", (F.col("left") - tolerance).alias("bl"), (F.col("top") - tolerance).alias("bt"), (F.col("left") + F.col("width") + tolerance).alias("br"), (F.col("top") + F.col("height") + tolerance).alias("bb"))
    hit = words.join(b, keys).where((F.col("x1") >= F.col("bl")) & (F.col("x0") <= F.col("br")) & (F.col("y1") >= F.col("bt")) & (F.col("y0") <= F.col("bb")))
    order = F.struct(F.bround("y0", 1).alias("y"), "x0", "ord", "word")
    return hit.groupBy(*keys, "box_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["word"]), " ").alias("region_text"))


def contains_sequence(tokens: Column, wanted: Column) -> Column:
    """Whether ``wanted`` stands as a run in ``tokens``; an empty ``wanted`` doesn't. Tokens hold no blanks, so the joined
    texts tell."""
    edge = lambda x: F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" "))
    return (F.size(wanted) > 0) & F.contains(edge(tokens), edge(wanted))


def winner(region: Column, a: Column, b: Column) -> Column:
    """'A' or 'B' if exactly one candidate's tokens stand in the region, else null."""
    region_tokens = T.tokens(region)
    in_a, in_b = contains_sequence(region_tokens, T.tokens(a)), contains_sequence(region_tokens, T.tokens(b))
    return F.when(in_a & ~in_b, "A").when(in_b & ~in_a, "B")


def best_overlap(targets: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, target_id, block_id, area): of each target box the block with the largest overlap, the first of equals."""
    fields = ("left", "top", "width", "height")
    a = targets.select(*keys, "target_id", F.struct(*fields).alias("_a"))
    b = blocks.select(*keys, "block_id", F.struct(*fields).alias("_b"))
    met = a.join(b, keys).withColumn("area", T.overlap_area(F.col("_a"), F.col("_b"))).where("area > 0")
    w = Window.partitionBy(*keys, "target_id").orderBy(F.desc("area"), "block_id")
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, "target_id", "block_id", "area")


def new_images(existing: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Images of ``found`` whose box, or locator where there is none, ``existing`` lacks; of equal ones the first by image_id."""
    identity = F.coalesce(F.concat_ws(",", F.lit("bbox"), "left", "top", "width", "height"), F.lit(""))
    own = F.when(F.col("left").isNotNull(), identity).otherwise(F.concat(F.lit("locator,"), F.coalesce(T.normalised("locator"), F.lit(""))))
    fresh = found.withColumn("_key", own).join(existing.withColumn("_key", own).select(*keys, "_key").distinct(), [*keys, "_key"], "left_anti")
    w = Window.partitionBy(*keys, "_key").orderBy("image_id")
    return fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_key")


def missing_pages(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The pages (keys, page_no from 1 to page_count) that an extraction lacks; ``expected``: (keys, page_count)."""
    every = expected.where(F.col("page_count") >= 1).select(*keys, F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page_no"))
    return every.join(found.select(*keys, F.col("page_no").cast("int").alias("page_no")).distinct(), [*keys, "page_no"], "left_anti")


def same_page_set(primary: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, route): 'merge' where both extractions report the same pages, else 'native', the other one alone."""
    a = primary.select(*keys, "page_no").distinct().withColumn("_a", F.lit(1))
    b = other.select(*keys, "page_no").distinct().withColumn("_b", F.lit(1))
    met = a.join(b, [*keys, "page_no"], "full_outer").groupBy(*keys).agg(F.bool_and(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("same"))
    return met.select(*keys, F.when(F.col("same"), "merge").otherwise("native").alias("route"))


def matched_images(images: DataFrame, pictures: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, image_id, picture_id): image nodes (image_id, name, left, top, width, height) with the stored picture of the same
    name and box, or else of the same box; the first picture_id of equals. Boxes are compared as whole numbers."""
    whole = [F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(f"_{c}") for c in ("left", "top", "width", "height")]
    box = ["_left", "_top", "_width", "_height"]
    p = pictures.select(*keys, "picture_id", T.normalised("name").alias("_name"), *whole)
    exact = p.where(F.col("_name").isNotNull()).groupBy(*keys, "_name", *box).agg(F.min("picture_id").alias("_exact"))
    loose = p.groupBy(*keys, *box).agg(F.min("picture_id").alias("_loose"))
    own = images.select(*keys, "image_id", T.normalised("name").alias("_name"), *whole)
    return own.join(exact, [*keys, "_name", *box], "left").join(loose, [*keys, *box], "left").select(*keys, "image_id", F.coalesce("_exact", "_loose").alias("picture_id"))


def zipped_media(images: DataFrame, media: DataFrame, keys: list[str], image_order: str, media_order: str) -> DataFrame:
    """(image columns, media columns): the n-th image of each document with its n-th medium, null where there is none."""
    number = lambda df, order: df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return number(images, image_order).join(number(media, media_order), [*keys, "_n"], "left").drop("_n")


def page_text(page: Column, blocks: Column) -> Column:
    """A page's own text, or where it is blank that of its blocks (an array) line by line."""
    joined = F.array_join(F.filter(F.transform(blocks, T.normalised), lambda x: x.isNotNull()), "\n")
    return F.coalesce(F.when(T.normalised(page).isNotNull(), page), F.nullif(joined, F.lit("")))


def has_text_layer(words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, has_text) of raw words (keys, word): whether any isn't blank."""
    return words.groupBy(*keys).agg(F.coalesce(F.bool_or(T.normalised("word").isNotNull()), F.lit(False)).alias("has_text"))


def pdf_route(available: Column, usable: Column, ocr: Column) -> Column:
    """Which extractor a paged document goes to: the layout model if there is one and text or OCR to work on."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(available) & (yes(usable) | yes(ocr)), "layout").otherwise("fallback")
