"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunset_engine.session import scratch_path

# A dimension side up to this many rows is shipped to every executor.
# Airports worldwide are ~80k rows of a few columns, far below this bound.
DEFAULT_BROADCAST_ROWS = 2_000_000


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows (one count; Parquet files answer it from their footers)."""
    return df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast join only when ``df`` is proven to hold at most ``max_rows`` rows.

    The check is one count. Above the
    bound the plain frame is returned, and Spark plans a shuffle join (with AQE
    free to switch strategies at run time).
    """
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def spread(df: DataFrame, parts: int = 0) -> DataFrame:
    """``df`` dealt evenly over two tasks a slot (or ``parts``, if more), for rows of few bytes that take much work.

    Files are split by bytes: a table of short rows is one task, whatever has to be done with each.
    The number is given, so AQE does not join the tasks again by their bytes.
    """
    return df.repartition(max(parts, 2 * df.sparkSession.sparkContext.defaultParallelism))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing the pipeline) and costs one job, unlike ``checkpoint()``, which
    computes an unpersisted input twice. Nothing looks for a _SUCCESS file, and none is made:
    on a local file system each file made starts a process to set its mode.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.parquet(path)
