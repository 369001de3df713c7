"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; columns are pruned and filters pushed down by whoever reads on."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(df: DataFrame, name: str, kind: str):
    """``name`` cast to ``kind``, or a typed null where the table lacks it: optional columns never break a plan."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)
