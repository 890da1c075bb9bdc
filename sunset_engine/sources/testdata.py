"""Adapters that present the driver's parquet tables as flights, airports and strikes.

The test tables hold no aviation data, so these views derive it deterministically:
airports from ``nation``, flights and strikes from ``events``, a bird-density
raster from ``lineitem``. Each adapter is a plain projection (or one aggregate for
the raster) over a whole table, so the work grows with the scale factor.
The same derivations are written as SQL in ``sunset_engine.plans.oracle`` for
the DuckDB cross-check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Raster of the test data: the reference grid bounds at 10 km per cell.
TEST_GRID_RESOLUTION = 10000.0
TEST_GRID_HEIGHT = 290
TEST_GRID_WIDTH = 461
# Zones of 50 miles to the corner, so a zone covers about 11 x 11 of those cells.
TEST_ZONE_MILES = 50.0
# Season used with the January-only events table (exclusive ends, F2).
TEST_FLIGHT_SEASON = ((1, 5), (1, 25))
TEST_FLIGHT_YEARS = (2024, 2024)
# Strike season (inclusive, F3): years and months.
TEST_STRIKE_YEARS = (2024, 2024)
TEST_STRIKE_MONTHS = (1, 1)

# Fixed airport-type labels per nation region (stands in for the airports `type` column).
REGION_AIRPORT_TYPE = {0: "small_airport", 1: "heliport", 2: "medium_airport",
                       3: "large_airport", 4: "large_airport"}
# Fixed airport-type labels per customer market segment (airport sites, see `sites`).
SEGMENT_AIRPORT_TYPE = {"AUTOMOBILE": "small_airport", "BUILDING": "large_airport", "FURNITURE": "seaplane_base",
                        "HOUSEHOLD": "heliport", "MACHINERY": "medium_airport"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _code(key) -> "F.Column":
    return F.concat(F.lit("A"), F.lpad(key.cast("string"), 2, "0"))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per nation: id, position inside the continental grid, type."""
    n = F.col("n_nationkey")
    type_col = F.lit(None).cast("string")
    for region, label in REGION_AIRPORT_TYPE.items():
        type_col = F.when(F.col("n_regionkey") == region, F.lit(label)).otherwise(type_col)
    return read_table(spark, sf_dir, "nation").select(
        _code(n).alias("airport_id"),
        (F.lit(27.3) + (n * 8) % 21).cast("double").alias("latitude_deg"),
        (F.lit(-120.7) + (n * 11) % 50).cast("double").alias("longitude_deg"),
        type_col.alias("type"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport sites, one per customer: a dimension that grows with the scale factor.

    Positions spread over the continental grid (latitude 27.3-47.29, longitude
    -120.7 to -71.71); the market segment stands in for the airport type. The
    geometry and dimension reports run on these; the flight pipeline keeps the
    nation airports that the flights refer to.
    """
    k = F.col("c_custkey")
    type_col = F.lit(None).cast("string")
    for segment, label in SEGMENT_AIRPORT_TYPE.items():
        type_col = F.when(F.col("c_mktsegment") == segment, F.lit(label)).otherwise(type_col)
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.lpad(k.cast("string"), 6, "0")).alias("airport_id"),
        (F.lit(27.3) + ((k * 37) % 2000) / 100.0).alias("latitude_deg"),
        (F.lit(-120.7) + ((k * 53) % 4900) / 100.0).alias("longitude_deg"),
        type_col.alias("type"),
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-error event is a flight; its clock time is the local departure time.

    ``dep_time``/``arr_time`` are ``hhmm.0`` texts as in the flight CSVs; every
    40th departure is blank, which the time-validity filter must drop.
    """
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") != "error")
    minute = F.hour("ts") * 60 + F.minute("ts")
    arr = (minute + 90) % 1440
    return ev.select(
        "event_id",
        F.col("ts").cast("date").alias("flight_date"),
        _code(F.col("user_id") % 25).alias("origin"),
        _code(F.col("event_id") % 25).alias("dest"),
        F.when(F.col("event_id") % 40 == 0, F.lit(""))
         .otherwise(F.concat((F.hour("ts") * 100 + F.minute("ts")).cast("string"), F.lit(".0")))
         .alias("dep_time"),
        F.concat((F.floor(arr / 60) * 100 + arr % 60).cast("string"), F.lit(".0")).alias("arr_time"),
    )


def strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error event is a bird strike, with raw text fields as in the strike CSV."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    slot = F.col("user_id") % 25
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return ev.select(
        "event_id",
        F.concat_ws("/", two(F.month("ts")), two(F.dayofmonth("ts")), F.year("ts").cast("string"))
         .alias("incident_date"),
        F.month("ts").cast("int").alias("incident_month"),
        F.year("ts").cast("int").alias("incident_year"),
        F.when(F.col("event_id") % 47 == 0, F.lit(" "))
         .otherwise(F.concat_ws(":", two(F.hour("ts")), two(F.minute("ts")))).alias("time"),
        F.concat(F.lit("K"), _code(slot)).alias("airport_id"),
        F.when(F.col("event_id") % 50 == 0, F.lit(""))
         .when(F.col("event_id") % 51 == 0, F.lit("n/a"))
         .otherwise((F.lit(27.3) + (slot * 8) % 21).cast("double").cast("string"))
         .alias("airport_latitude"),
        (F.lit(-120.7) + (slot * 11) % 50).cast("double").cast("string").alias("airport_longitude"),
    )


def raster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse bird-density raster: line items binned into grid cells.

    ``value`` is the summed quantity of the cell's non-returned items (NULL when
    all of them are returned, which exercises the NaN/NULL-to-zero rule). Cells
    without items are absent and count as 0.
    """
    li = read_table(spark, sf_dir, "lineitem")
    return (
        li.select(
            (F.col("l_orderkey") % TEST_GRID_HEIGHT).cast("int").alias("row"),
            ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % TEST_GRID_WIDTH).cast("int").alias("col"),
            F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
             .otherwise(F.col("l_quantity")).alias("q"),
        )
        .groupBy("row", "col")
        .agg(F.sum("q").alias("value"))
    )


def timezone_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a timezone file: one per customer, coded by the customer's nation."""
    cust = read_table(spark, sf_dir, "customer")
    return cust.select(_code(F.col("c_nationkey")).alias("code"), F.col("c_custkey").alias("site_id"))
