"""Reliable lineage cuts and bounded broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it is proven to have at most this many rows.
BROADCAST_ROWS = 20_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where that is unset a temporary one serves local sessions, as in
    tests; on a cluster its absence is an error, since a folder of one machine can't be shared."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lectern-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Where tables that outlive a lost executor are written: the checkpoint folder."""
    return ensure_checkpoint_dir(spark)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder, so that a lost executor never forces the whole lineage again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def broadcast_checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else ``df`` as it is (Catalyst then shuffles).

    The check reads at most ``rows + 1`` rows.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
