"""End-to-end jobs over files, one per workflow of the reference.

* ``ingest_flights`` flight CSVs -> Parquet partitioned by year and month
* ``flight_job``   near-sunset flights -> frequencies -> strikes per flight -> top/bottom N reports
* ``strike_job``   near-sunset bird strikes -> counts per airport
* ``ratio_report`` flight counts LEFT JOIN strike counts -> ratio, sorted
* ``zonal_job``    airports -> zones -> zonal mean of a raster cell table
* ``training_job`` zonal means JOIN strikes per flight -> training table
* ``stats_job``    Pearson r, its p-value, least-squares line and R^2
* ``model_job``    cross-validated random forest -> saved model, predictions, metrics
* ``code_check``   codes of a data file missing from a code list

Each job reads its inputs, writes its outputs under ``out_dir`` and returns the
output DataFrames. Large outputs are written as distributed part files; only
the bounded per-airport reports are written as single files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.functions.text import drop_first_char, strip_quotes
from sunset_engine.operators import model as M
from sunset_engine.operators import quality as QL
from sunset_engine.operators import raster as R
from sunset_engine.operators import stats as ST
from sunset_engine.operators import traffic as T
from sunset_engine.operators.joins import materialize
from sunset_engine.operators.season import FALL_END, FALL_MONTHS, FALL_START, FALL_YEARS
from sunset_engine.operators.timezones import with_timezones
from sunset_engine.sources import csvio


COUNT_SCHEMA = "airport_id string, latitude_deg double, longitude_deg double, {} long"


def ingest_flights(spark: SparkSession, csv_path: str, out_path: str, mode: str = "errorifexists") -> None:
    """Convert flight CSVs once into Parquet partitioned by year and month.

    Later runs read five columns instead of whole lines, and the season filter
    prunes month folders (August to November is 4 of 12).
    """
    f = csvio.read_flights(spark, csv_path)
    # Rows of a month are brought together to keep files few; Spark splits the months that are too large for one task.
    (f.withColumns({"flight_year": F.year("flight_date"), "flight_month": F.month("flight_date")})
     .hint("rebalance", "flight_year", "flight_month")
     .write.mode(mode).partitionBy("flight_year", "flight_month").parquet(out_path))


def flight_job(spark: SparkSession, flights_path: str, airports_path: str, strike_counts_path: str,
               out_dir: str, n: int = 50, start=FALL_START, end=FALL_END, years: tuple[int, int] | None = None,
               offset: str = "timezone", mode: str = "errorifexists",
               flights_format: str = "csv", timezones_path: str | None = None) -> dict[str, DataFrame]:
    """Near-sunset flight ends and the per-airport reports built from them.

    All years are kept unless ``years`` gives a first and a last one. ``timezones_path`` names a
    file of airport codes and IANA zones; airports without an entry take the nearest reference point's.

    ``flights_format="parquet"`` reads the output of ``ingest_flights``, whose
    year/month partitions the season filter prunes.
    """
    flights = (spark.read.parquet(flights_path) if flights_format == "parquet"
               else csvio.read_flights(spark, flights_path))
    airports = csvio.read_airports(spark, airports_path)
    if timezones_path:
        airports = with_timezones(airports, csvio.read_timezones(spark, timezones_path))
    near = T.near_sunset_flights(flights, airports, start, end, years, offset)
    near = materialize(near, "near_sunset_flights")            # one pass over the flights, reused below
    csvio.write_csv(near, os.path.join(out_dir, "sunset_flights"), mode=mode)
    freq = materialize(T.flight_frequencies(near), "flight_frequencies")
    csvio.write_single_csv(freq, os.path.join(out_dir, "flight_frequencies"), mode=mode)
    strikes = spark.read.schema(COUNT_SCHEMA.format("strike_count")).option("header", True).csv(strike_counts_path)
    spf = T.strike_per_flight(freq, strikes)
    csvio.write_csv(spf, os.path.join(out_dir, "strike_per_flight"), header=False, mode=mode)
    top = T.top_n(freq, "flight_count", T.GROUP_KEY, n)
    bottom = T.top_n(freq, "flight_count", T.GROUP_KEY, n, ascending=True)
    csvio.write_single_csv(top, os.path.join(out_dir, "top_n"), mode=mode)
    csvio.write_single_csv(bottom, os.path.join(out_dir, "bottom_n"), mode=mode)
    csvio.write_single_csv(top.unionByName(bottom), os.path.join(out_dir, "top_and_bottom"), mode=mode)
    return {"near": near, "frequencies": freq, "strike_per_flight": spf, "top": top, "bottom": bottom}


def strike_job(spark: SparkSession, strikes_path: str, out_path: str, header: bool = False, years=FALL_YEARS,
               months=FALL_MONTHS, offset: str = "timezone", mode: str = "errorifexists",
               timezones_path: str | None = None) -> DataFrame:
    """Near-sunset strikes counted per (airport, latitude, longitude), one CSV with header.

    ``timezones_path``: airport codes (of three letters) and IANA zones; else the nearest reference point's.
    """
    strikes = csvio.read_strikes(spark, strikes_path, header)
    if timezones_path:
        strikes = with_timezones(strikes, csvio.read_timezones(spark, timezones_path),
                                 drop_first_char(strip_quotes("airport_id")))
    counts = T.strike_counts(T.near_sunset_strikes(strikes, years, months, offset))
    csvio.write_single_csv(counts, out_path, mode=mode)
    return counts


def ratio_report(spark: SparkSession, frequencies_path: str, strike_counts_path: str, out_path: str) -> DataFrame:
    """Strikes per flight for every airport with flights (0 strikes when none), sorted by ratio."""
    freq = spark.read.schema(COUNT_SCHEMA.format("flight_count")).option("header", True).csv(frequencies_path)
    counts = spark.read.schema(COUNT_SCHEMA.format("strike_count")).option("header", True).csv(strike_counts_path)
    report = T.strike_ratio_left(freq, counts)
    csvio.write_sorted_report(report, out_path, ["strike_ratio", *T.GROUP_KEY])
    return report


def zonal_job(spark: SparkSession, airports_path: str, cells_path: str, out_path: str, zone_miles: float = 5.0,
              types: list[str] | None = None, mode: str = "errorifexists") -> DataFrame:
    """Mean normalised raster value around each airport: ``airport_id, bird_population``."""
    ap = spark.read.option("header", True).csv(airports_path)
    keys = T.airport_keys(ap.select("airport_id", "latitude_deg", "longitude_deg",
                                    *(["type"] if "type" in ap.columns else [])), types)
    zones = materialize(R.airport_zones(keys.select(*R.ZONE_KEY), zone_miles), "zones")
    means = R.zonal_mean(zones, csvio.read_cells(spark, cells_path)).select("airport_id", "bird_population")
    csvio.write_single_csv(means, out_path, mode=mode)
    return means


def training_job(spark: SparkSession, zonal_path: str, strike_per_flight_path: str, out_path: str,
                 mode: str = "errorifexists") -> DataFrame:
    """Zonal means JOIN strikes per flight on the airport code."""
    zonal = spark.read.schema("airport_id string, bird_population double").option("header", True).csv(zonal_path)
    spf = spark.read.schema("airport_id string, latitude_deg double, longitude_deg double, strike_count double, "
                            "flight_count double, strike_ratio double").csv(strike_per_flight_path)
    table = zonal.join(spf.select("airport_id", F.col("strike_count").alias("bird_strike_count"), "flight_count",
                                  F.col("strike_ratio").alias("bird_flight_ratio")), "airport_id")
    csvio.write_single_csv(table, out_path, mode=mode)
    return table


def stats_job(spark: SparkSession, training_path: str, x: str = "bird_population",
              y: str = "bird_flight_ratio") -> DataFrame:
    """One row: n, Pearson r, p-value, slope, intercept, R^2."""
    t = csvio.read_training(spark, training_path)
    return ST.summary(t, x, y).withColumn("p_value", ST.t_test_p_value("pearson_r", "n"))


def model_job(spark: SparkSession, training_path: str, out_prefix: str, cross_validate: bool = True,
              parallelism: int | None = None, model_suffix: str = "-model",
              predictions_suffix: str = "-predictions") -> tuple[DataFrame, dict[str, float]]:
    """Cross-validated forest: saves the best pipeline and the test predictions, returns metrics."""
    train, test = map(M.prepare, M.split(csvio.read_training(spark, training_path).na.drop()))
    model = M.cross_validate(train, parallelism=parallelism).bestModel if cross_validate else M.fit_forest(train)
    M.save(model, out_prefix + model_suffix)
    pred = M.predictions(model, test)
    csvio.write_csv(pred, out_prefix + predictions_suffix, mode="overwrite")
    return pred, M.evaluate(pred)


def code_check(spark: SparkSession, codes_path: str, data_path: str, kind: str = "flights") -> DataFrame:
    """Codes used in a flight file (origin and destination) or a timezone file, absent from the code list."""
    known = csvio.read_code_list(spark, codes_path, sep=";")
    if kind == "flights":
        used = QL.flight_codes(csvio.read_flights(spark, data_path))
    else:
        used = csvio.read_code_list(spark, data_path, sep=",")
    return QL.missing_codes(used, known).orderBy("code")
