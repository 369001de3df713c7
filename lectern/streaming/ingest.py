"""Incremental ingestion: new files once, unchanged sources reused, late repeats dropped within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import text as X
from lectern.sources import office

FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def ingest_files(spark: SparkSession, folder: str, target: str, checkpoint: str, extractors: dict | None = None):
    """Reads files that came since the last run, extracts their blocks and appends them to ``target`` as Parquet.

    Each micro-batch is keyed by content hash; content that ``target`` already has is left out, so a file delivered again
    under another name adds nothing. Runs over what is there and stops; returns the query.
    """
    stream = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").load(folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        hashed = batch.withColumn("source_hash", X.file_hash("content")).dropDuplicates(["source_hash"])
        try:
            known = batch.sparkSession.read.parquet(target).select("source_hash").distinct()
            hashed = hashed.join(known, "source_hash", "left_anti")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
        made = office.blocks(hashed, extractors).join(hashed.select("path", "source_hash"), "path")
        made.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, key: str, event_time: str, late: str = "10 minutes") -> DataFrame:
    """A stream without repeats of a key that arrive within the watermark; state is bounded by it."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, event_time: str, by: str, value: str, width: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """(window_start, by, n, total) in tumbling windows; works on a stream (with a watermark) and on a table alike."""
    timed = events.withWatermark(event_time, late) if late and events.isStreaming else events
    return timed.groupBy(F.window(event_time, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, user: str, event_time: str, gap: str = "30 minutes", late: str | None = "1 hour") -> DataFrame:
    """(user, session_start, session_end, n) of runs of events less than ``gap`` apart."""
    timed = events.withWatermark(event_time, late) if late and events.isStreaming else events
    return timed.groupBy(F.col(user), F.session_window(event_time, gap).alias("w")).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def run_memory(stream: DataFrame, name: str, mode: str = "append", before: Callable | None = None):
    """Runs a stream over what is there into an in-memory table (for tests and small reports)."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
