"""Near-sunset flight counts over a stream of arriving flight files.

The reference is batch-only; this module runs the *same* batch operators on
each micro-batch of a Structured Streaming file source, for flight files that
keep landing in a folder. Each batch writes its partial per-airport counts under
its batch id (an idempotent overwrite, so a replayed batch after a failure
replaces its own output); the running totals are a plain sum over the partials.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sunset_engine.operators import traffic as T


def start_counts(spark: SparkSession, source_dir: str, schema: StructType, airports: DataFrame,
                 out_dir: str, checkpoint: str, fmt: str = "parquet", **season) -> StreamingQuery:
    """Start the stream: every micro-batch -> near-sunset ends -> counts -> ``out_dir/batch_id=N``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = T.flight_frequencies(T.near_sunset_flights(batch, airports, **season))
        counts.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    return (stream.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def running_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current per-airport totals: sum of the partial counts of all batches so far."""
    return (spark.read.parquet(out_dir).groupBy(*T.GROUP_KEY)
            .agg(F.sum("flight_count").alias("flight_count")))
