"""Data-quality checks: unknown airport codes (J6, J7, A4) and dataset profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flight_codes(flights: DataFrame) -> DataFrame:
    """Distinct origin and destination codes of a flight table (A4)."""
    return (flights.select(F.explode(F.array("origin", "dest")).alias("code"))
            .distinct())


def missing_codes(codes: DataFrame, known: DataFrame, known_col: str = "code") -> DataFrame:
    """Codes absent from the known list: a hash anti-join on distinct codes.

    Both sides are deduplicated first (partial aggregate per task), so the
    shuffle carries distinct codes only, however many rows mention them.
    """
    k = known.select(F.col(known_col).alias("code")).distinct()
    return codes.select("code").distinct().join(k, "code", "left_anti")


def profile(df: DataFrame) -> DataFrame:
    """One-row profile: row count and NULL count per column.

    A single aggregate pass; the driver receives one row whatever the table size.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    return df.agg(*aggs)
