"""Models that plug in: recognising text in pictures and describing them. Off until a provider is given; failures are a status."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T

Recogniser = Callable[[bytes], list[tuple[str, float]]]
Describer = Callable[[str, str], str]
#: Source types whose pictures are recognised, and characters of context a describer gets (fixed values).
OCR_TYPES, CONTEXT_CHARS = ("xlsx", "ppt", "pptx"), 1_200


def recognised(images: DataFrame, recogniser: Recogniser | None = None) -> DataFrame:
    """Images (image_id, source_type, content) with ocr_status, ocr_text and ocr_confidence: 'off' without a recogniser, 'skipped' for
    other source types, 'missing' without content, 'failed' where it raises, 'empty' or 'ok'. Blocks below 0.5 are left out."""
    kind = F.when(F.col("content").isNull(), "missing").when(~F.lower("source_type").isin(*OCR_TYPES) | F.col("source_type").isNull(), "skipped").otherwise("ok")
    if recogniser is None:
        return images.select("image_id", F.lit("off").alias("ocr_status"), F.lit(None).cast("string").alias("ocr_text"), F.lit(None).cast("double").alias("ocr_confidence"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, status, content in zip(*(c.to_pylist() for c in batch.columns)):
                blocks = []
                if status == "ok":
                    try:
                        blocks = [{"text": t, "score": float(s)} for t, s in recogniser(content)]
                    except Exception:
                        status = "failed"
                rows.append((name, status, blocks))
            names = ["image_id", "ocr_status", "blocks"]
            kinds = (pa.string(), pa.string(), pa.list_(pa.struct([("text", pa.string()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, kinds)], names=names)

    read = images.select(F.col("image_id").cast("string").alias("image_id"), kind.alias("status"), "content").mapInArrow(run, "image_id string, ocr_status string, blocks array<struct<text string, score double>>")
    found = read.withColumn("r", T.recognised_text(F.col("blocks")))
    text = F.nullif("r.text", F.lit(""))
    return found.select("image_id", F.when((F.col("ocr_status") == "ok") & text.isNull(), "empty").otherwise(F.col("ocr_status")).alias("ocr_status"), text.alias("ocr_text"), F.col("r.confidence").alias("ocr_confidence"))


def data_url(content: bytes, extension: str) -> str:
    """A picture as a data URL, as vision endpoints take it."""
    kind = {"jpg": "jpeg", "tif": "tiff"}.get(extension.lower().lstrip("."), extension.lower().lstrip("."))
    return f"data:image/{kind};base64,{base64.b64encode(content).decode()}"


def description_context(title: Column, section: Column, around: Column) -> Column:
    """What a describer is told of a picture's place, at most ``CONTEXT_CHARS`` characters."""
    parts = F.array_compact(F.array(*[F.concat(F.lit(f"{name}: "), T.normalised(c)) for name, c in (("Document", title), ("Section", section), ("Nearby text", around))]))
    return F.substring(F.array_join(parts, "\n"), 1, CONTEXT_CHARS)


def described(images: DataFrame, describer: Describer | None = None) -> DataFrame:
    """Images (image_id, content, extension, context) with description, description_status and inferred (true: a model said so):
    'off' without a describer, 'skipped' without content, 'failed' where it raises or says nothing, else 'ok'."""
    if describer is None:
        return images.select("image_id", F.lit(None).cast("string").alias("description"), F.lit("off").alias("description_status"), F.lit(False).alias("inferred"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content, extension, context in zip(*(c.to_pylist() for c in batch.columns)):
                said, status = None, "skipped"
                if content is not None:
                    try:
                        said = describer(data_url(content, extension or "png"), context or "").strip() or None
                        status = "ok" if said else "failed"
                    except Exception:
                        status = "failed"
                rows.append((name, said, status, status == "ok"))
            names = ["image_id", "description", "description_status", "inferred"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.string(), pa.string(), pa.bool_()))], names=names)

    own = images.select(F.col("image_id").cast("string").alias("image_id"), "content", "extension", "context")
    return own.mapInArrow(run, "image_id string, description string, description_status string, inferred boolean")
