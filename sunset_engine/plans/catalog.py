"""The query catalog: one DataFrame query per operator group, over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Column names
match the SQL texts in ``sunset_engine.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.functions import text as X
from sunset_engine.functions.columns import round_significant, to_double
from sunset_engine.functions.geo import GRID_BOUNDS
from sunset_engine.functions.timeparse import clock_to_minutes, hhmm_to_minutes, parse_iso_date, parse_us_date
from sunset_engine.operators import forest as FO
from sunset_engine.operators import model as M
from sunset_engine.operators import quality as QL
from sunset_engine.operators import raster as R
from sunset_engine.operators import stats as ST
from sunset_engine.operators import traffic as T
from sunset_engine.operators.nearest import with_nearest
from sunset_engine.operators.season import season_exclusive, season_inclusive
from sunset_engine.operators.timezones import nearest_timezone, timezone_points
from sunset_engine.session import scratch_path
from sunset_engine.sources import csvio
from sunset_engine.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
START, END = TD.TEST_FLIGHT_SEASON


def near_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.near_sunset_flights(TD.flights(spark, sf_dir), TD.airports(spark, sf_dir), START, END,
                                 TD.TEST_FLIGHT_YEARS, offset="longitude")


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.flight_frequencies(near_flights(spark, sf_dir))


def top_airports(spark: SparkSession, sf_dir: str, n: int = 50) -> DataFrame:
    """Flagship: airports with the most flight ends near local sunset."""
    return T.top_n(frequencies(spark, sf_dir), "flight_count", T.GROUP_KEY, n)


def near_strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.near_sunset_strikes(TD.strikes(spark, sf_dir), TD.TEST_STRIKE_YEARS, TD.TEST_STRIKE_MONTHS,
                                 offset="longitude")


def near_strikes_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strikes near sunset at the time of the zone of their place."""
    return T.near_sunset_strikes(TD.strikes(spark, sf_dir), TD.TEST_STRIKE_YEARS, TD.TEST_STRIKE_MONTHS, offset="timezone")


def strike_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.strike_counts(near_strikes(spark, sf_dir))


# Known-code list of the checks: medium and large airports only.
KNOWN_TYPES = ["medium_airport", "large_airport"]
# Order-date season for the orders table (its dates span 1995-2001).
ORDER_YEARS = (1996, 1998)


def season_filter_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = TD.read_table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
            .where(season_exclusive("order_date")))


def season_filter_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = TD.read_table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", F.year("o_orderdate").alias("order_year"),
                     F.month("o_orderdate").alias("order_month"))
            .where(season_inclusive("order_year", "order_month", ORDER_YEARS)))


def hhmm_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = TD.flights(spark, sf_dir)
    return f.select("event_id", hhmm_to_minutes("dep_time").alias("dep_minute"),
                    hhmm_to_minutes("dep_time", compat=True).alias("dep_minute_compat"),
                    hhmm_to_minutes("arr_time").alias("arr_minute"))


def parse_strike_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TD.strikes(spark, sf_dir)
    return (s.where(F.trim(F.regexp_replace("time", '"', "")) != "")
            .select("event_id", parse_us_date("incident_date").alias("incident_date"),
                    clock_to_minutes("time").alias("event_minute")))


def clean_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TD.strikes(spark, sf_dir)
    return (s.select("event_id", to_double("airport_latitude").alias("latitude_deg"),
                     to_double("airport_longitude").alias("longitude_deg"))
            .na.drop())


def airport_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.airport_keys(TD.sites(spark, sf_dir), KNOWN_TYPES)


def text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = TD.read_table(spark, sf_dir, "supplier")
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"))
    return (sup.select("s_suppkey", line.alias("line"), "s_name")
            .select("s_suppkey", "line",
                    X.before_first("line").alias("first_field"),
                    X.after_last("line").alias("last_field"),
                    X.field("line", 1).alias("second_field"),
                    X.drop_first_char("s_name").alias("name_tail"),
                    X.key_line("s_suppkey", "s_name", ": ").alias("key_line")))


def first_rows(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    o = TD.read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(n)


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = TD.read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("line_count"))


def known_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.airport_keys(TD.airports(spark, sf_dir), KNOWN_TYPES).select(F.col("airport_id").alias("code"))


def missing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QL.missing_codes(QL.flight_codes(TD.flights(spark, sf_dir)), known_codes(spark, sf_dir))


def missing_timezones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QL.missing_codes(TD.timezone_sites(spark, sf_dir), known_codes(spark, sf_dir))


def airport_timezones(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = TD.sites(spark, sf_dir)
    return a.select("airport_id", nearest_timezone("latitude_deg", "longitude_deg").alias("timezone"))


def near_flights_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.near_sunset_flights(TD.flights(spark, sf_dir), TD.airports(spark, sf_dir), START, END,
                                 TD.TEST_FLIGHT_YEARS, offset="timezone")


GRID = dict(bounds=GRID_BOUNDS, resolution=TD.TEST_GRID_RESOLUTION)


def airports_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.airport_keys(TD.airports(spark, sf_dir)).select(*R.ZONE_KEY)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of the airports the flights use (one row per airport inside the grid)."""
    return R.airport_zones(airports_geo(spark, sf_dir), TD.TEST_ZONE_MILES, **GRID)


def sites_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.airport_keys(TD.sites(spark, sf_dir)).select(*R.ZONE_KEY)


def site_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of all airport sites (grows with the scale factor)."""
    return R.airport_zones(sites_geo(spark, sf_dir), TD.TEST_ZONE_MILES, **GRID)


def zonal_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.zonal_mean(zones(spark, sf_dir), TD.raster_cells(spark, sf_dir), **GRID)


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal bird population joined to strikes per flight (J5): the model's input table."""
    spf = T.strike_per_flight(frequencies(spark, sf_dir), strike_counts(spark, sf_dir))
    return (zonal_means(spark, sf_dir).select("airport_id", "bird_population")
            .join(spf.select("airport_id", F.col("strike_count").alias("bird_strike_count"), "flight_count",
                             F.col("strike_ratio").alias("bird_flight_ratio")), "airport_id"))


def _r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (cross-engine comparison of sums)."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _sig(df: DataFrame) -> DataFrame:
    """Round every double column to 10 significant digits (large sums across engines)."""
    return df.select(*[round_significant(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def lineitem_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TD.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                           "l_extendedprice")


def fitted_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.fit_residuals(lineitem_xy(spark, sf_dir), "l_quantity", "l_extendedprice",
                            ["l_orderkey", "l_linenumber"])


def training_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r6(ST.summary(training_table(spark, sf_dir), "bird_population", "bird_flight_ratio"))


def model_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    data = M.prepare(training_table(spark, sf_dir))
    return M.split(data, key="airport_id")


def rf_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which part of the keyed 70/30 split each training row is in (M6)."""
    train, test = model_input(spark, sf_dir)
    return (train.select("airport_id", F.lit("train").alias("part"))
            .unionAll(test.select("airport_id", F.lit("test").alias("part"))))


def rf_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that predictions are made for (M8): key, features and target of the test part."""
    _, test = model_input(spark, sf_dir)
    rows = test.select("airport_id", *M.FEATURES, M.LABEL)
    return rows.withColumns({c: F.round(c, 6) for c in ("bird_population", "bird_flight_ratio")})


def rf_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cross-validation fold of each training row, by the hash of its key (M4)."""
    train, _ = model_input(spark, sf_dir)
    return train.select("airport_id", M.fold_of("airport_id").alias("fold"))


def rf_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE of every fold by the forest that did not see it, from stored predictions (M4, M5)."""
    train, _ = model_input(spark, sf_dir)
    return M.fold_scores(M.out_of_fold(train, "airport_id"))


def saved_forest(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    train, test = model_input(spark, sf_dir)
    path = _file(spark, "forest")
    M.save(M.fit_forest(train), path)
    return path, test


def rf_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a forest that was saved in the shared folder and loaded again (K6)."""
    path, test = saved_forest(spark, sf_dir)
    return M.predictions(M.load(path), test)


def rf_node_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions by walking the nodes of a saved forest as rows, without the model library (M1-M3, M7)."""
    path, test = saved_forest(spark, sf_dir)
    return FO.score(test, FO.node_table(spark, path), list(M.FEATURES), M.FOREST["maxDepth"]).select("airport_id", *M.FEATURES, M.LABEL, "prediction")


def nation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small forest as rows: a tree of depth 2 for each nation, whose thresholds and values follow from its key."""
    n = TD.read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("k"))
    leaf = lambda i, v: F.struct(F.lit(i).alias("node"), F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold"),
                                 F.lit(None).cast("int").alias("left"), F.lit(None).cast("int").alias("right"), v.cast("double").alias("value"))
    inner = lambda i, f, t, left, right: F.struct(F.lit(i).alias("node"), F.lit(f).alias("feature"), t.cast("double").alias("threshold"),
                                                  F.lit(left).alias("left"), F.lit(right).alias("right"), F.lit(0.0).alias("value"))
    k = F.col("k")
    nodes = F.array(inner(0, 0, 5 + k * 2, 1, 4), inner(1, 1, 10000 + k * 1000, 2, 3), leaf(2, k), leaf(3, k * 2 + 1),
                    inner(4, 1, 70000 - k * 1000, 5, 6), leaf(5, k * 3 + 2), leaf(6, k * 5 - 7))
    return n.select(k.alias("tree"), F.inline(nodes))


def forest_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item scored by a forest given as rows (M7)."""
    return FO.score(lineitem_xy(spark, sf_dir), nation_forest(spark, sf_dir), ["l_quantity", "l_extendedprice"], 2).select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


def row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split without a key (M6), on a table whose rows repeat: rows by value and part."""
    rows = TD.read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("quantity"))
    train, test = M.split(rows)
    both = train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))
    return both.groupBy("l_returnflag", "l_linestatus", "quantity", "part").agg(F.count(F.lit(1)).alias("n"))


def depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per supplier, spread like the sites but beside them."""
    k = F.col("s_suppkey")
    return TD.read_table(spark, sf_dir, "supplier").select("s_name", (F.lit(27.3037) + ((k * 71) % 2000) / 100.0).alias("lat"), (F.lit(-120.6929) + ((k * 97) % 4900) / 100.0).alias("lon"))


def nearest_depot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier's point nearest to every site, by the cell index."""
    return with_nearest(TD.sites(spark, sf_dir), depots(spark, sf_dir), "s_name").select("airport_id", "s_name")


def timezone_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone of every site from the inline reference points, by the cell index."""
    return with_nearest(TD.sites(spark, sf_dir), timezone_points(spark), "timezone").select("airport_id", "timezone")


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text, some in another form or blank, read back as ISO dates."""
    o = TD.read_table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    text = (F.when(F.col("o_orderkey") % 7 == 0, F.date_format(day, "MM/dd/yyyy")).when(F.col("o_orderkey") % 11 == 0, F.lit(""))
            .otherwise(F.date_format(day, "yyyy-MM-dd")))
    return o.select("o_orderkey", text.alias("t")).select("o_orderkey", parse_iso_date("t").alias("order_date"))


def _file(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def flight_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights written as on-time CSV part files (a quoted comma in every line) and read back."""
    path, f = _file(spark, "flights-csv"), TD.flights(spark, sf_dir)
    fixed = {"Airline": "A, Inc.", "Cancelled": "False", "Diverted": "False", "CRSDepTime": "0", "DepDelayMinutes": "0", "DepDelay": "0"}
    own = {"FlightDate": "flight_date", "Origin": "origin", "Dest": "dest", "DepTime": "dep_time", "ArrTime": "arr_time"}
    csvio.write_csv(f.select(*[F.lit(fixed[c]).alias(c) if c in fixed else F.col(own[c]).cast("string").alias(c) for c in csvio.FLIGHT_COLUMNS]), path, mode="overwrite")
    return csvio.read_flights(spark, path).drop("event_id")


def flight_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight lines put together from many files, each with its header line, read without any of them."""
    path, f = _file(spark, "flights-joined"), TD.flights(spark, sf_dir)
    own = {"FlightDate": "flight_date", "Origin": "origin", "Dest": "dest", "DepTime": "dep_time", "ArrTime": "arr_time"}
    line = F.concat_ws(",", *[F.coalesce(F.col(own[c]).cast("string"), F.lit("")) if c in own else F.lit("0") for c in csvio.FLIGHT_COLUMNS])
    # A header before every hundredth flight, and before the first of every part.
    first = (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0) | (F.col("event_id") % 100 == 0)
    lines = f.select(F.explode(F.when(first, F.array(F.lit(",".join(csvio.FLIGHT_COLUMNS)), line)).otherwise(F.array(line))).alias("value"))
    lines.write.text(path)
    return csvio.read_flights(spark, path).drop("event_id")


def csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a delimited text column, with quoted commas, doubled quotes and values that don't fit."""
    c = TD.read_table(spark, sf_dir, "customer")
    key = F.when(F.col("c_custkey") % 13 == 0, "none").otherwise(F.col("c_custkey").cast("string"))
    line = F.concat_ws(",", key, F.concat(F.lit('"'), "c_name", F.lit(', Inc."')), F.concat(F.lit('"the ""'), "c_mktsegment", F.lit('"" one"')), (F.col("c_custkey") % 100 / 4).cast("string"))
    lines = c.select("c_custkey", F.when(F.col("c_custkey") % 17 != 0, line).alias("line"))
    return lines.select("c_custkey", X.csv_fields("line", "key bigint, name string, segment string, share double").alias("f")).select("c_custkey", "f.*")


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred from a CSV file, and of a column without values the declared one (S3)."""
    path = _file(spark, "part-csv")
    p = TD.read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    csvio.write_csv(p.select("p_partkey", F.concat(F.lit("n, "), k.cast("string")).alias("name"), (k / 4).alias("quarter"), F.when(k % 3 == 0, k % 2 == 0).alias("even"),
                             F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")).alias("day"), F.lit(None).cast("double").alias("nothing")), path)
    return csvio.column_types(csvio.read_inferred(spark, path, {"nothing": "double", "name": "string"}))


def cells_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster cells written by tile row and read back, all tiles."""
    path = _file(spark, "cells")
    csvio.write_cells(TD.raster_cells(spark, sf_dir), path)
    return csvio.read_cells(spark, path).select("row", "col", "value", "tile_row")


def code_list_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of the nations that have customers, as a ;-separated list in one file, read back by its first field."""
    path = _file(spark, "codes")
    n = TD.read_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))       # a nation is one of 25
    csvio.write_single_csv(n.select(F.concat(F.lit("N"), "c_nationkey").alias("Code"), "customers"), path, sep=";", quote_all=True)
    return csvio.read_code_list(spark, path)


def ratio_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratio report as its file holds it, read back (K5, K8)."""
    path = _file(spark, "ratio")
    report = T.strike_ratio_left(frequencies(spark, sf_dir), strike_counts(spark, sf_dir))
    csvio.write_sorted_report(report, path, ["strike_ratio", *T.GROUP_KEY])
    back = spark.read.schema("airport_id string, latitude_deg double, longitude_deg double, flight_count long, strike_count long, strike_ratio double")
    return back.option("header", True).csv(path)


def solar_calendar_fall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sunsets of the whole season at zone time, the day of the clock change included."""
    return T.calendar_solar_table(TD.sites(spark, sf_dir), years=(2019, 2019))


def rf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model_input(spark, sf_dir)
    return M.predictions(M.fit_forest(train), test)


def rf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single forest fit, then RMSE, MSE, MAE and R^2 on the test rows in one aggregate."""
    train, test = model_input(spark, sf_dir)
    return ST.regression_metrics(M.predictions(M.fit_forest(train), test), M.LABEL)


def rf_cross_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model_input(spark, sf_dir)
    return M.predictions(M.cross_validate(train).bestModel, test)


def queries() -> dict[str, Query]:
    return {
        "pearson": lambda s, d: _r6(ST.pearson(lineitem_xy(s, d), "l_quantity", "l_extendedprice")),
        "line_fit": lambda s, d: _r6(ST.line_fit(lineitem_xy(s, d), "l_quantity", "l_extendedprice")),
        "fit_residuals": lambda s, d: _r6(fitted_line(s, d)),
        "regression_metrics": lambda s, d: _sig(ST.regression_metrics(fitted_line(s, d), "l_extendedprice",
                                                                      "fitted")),
        "pearson_p_value": lambda s, d: ST.pearson_p_value(lineitem_xy(s, d), "l_quantity", "l_extendedprice")
        .select("n", F.round("pearson_r", 9).alias("pearson_r"), F.round("p_value", 9).alias("p_value")),
        "training_stats": training_stats,
        "rf_split": rf_split,
        "rf_test_rows": rf_test_rows,
        "iso_dates": iso_dates,
        "flight_csv": flight_csv,
        "cells_round_trip": cells_round_trip,
        "code_list_csv": code_list_csv,
        "ratio_report_file": ratio_report_file,
        "solar_calendar_fall": solar_calendar_fall,
        "rf_folds": rf_folds,
        "rf_fold_scores": rf_fold_scores,
        "rf_saved": rf_saved,
        "rf_node_scores": rf_node_scores,
        "forest_walk": forest_walk,
        "row_split": row_split,
        "nearest_depot": nearest_depot,
        "timezone_by_place": timezone_by_place,
        "flight_csv_headers": flight_csv_headers,
        "csv_columns": csv_columns,
        "inferred_types": inferred_types,
        "near_sunset_strikes_tz": near_strikes_tz,
        "rf_predictions": rf_predictions,
        "rf_metrics": rf_metrics,
        "rf_cross_validated": rf_cross_validated,
        "albers_forward": lambda s, d: R.project_airports(sites_geo(s, d)).select(
            "airport_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")),
        "albers_round_trip": lambda s, d: R.round_trip(R.project_airports(sites_geo(s, d))).select(
            "airport_id", F.round("lat_back", 9).alias("lat_back"), F.round("lon_back", 9).alias("lon_back")),
        "zone_corners": lambda s, d: site_zones(s, d).drop("latitude_deg", "longitude_deg"),
        "zone_outline": lambda s, d: R.zone_outline(site_zones(s, d)),
        "zone_labels": lambda s, d: R.zone_labels(site_zones(s, d)),
        "zone_pixels": lambda s, d: R.zone_pixels(site_zones(s, d), **GRID).select("airport_id", "row", "col"),
        "presence_raster": lambda s, d: R.presence_raster(site_zones(s, d)),
        "normalized_raster": lambda s, d: R.normalized_cells(TD.raster_cells(s, d), **GRID).select(
            "row", "col", F.round("value", 6).alias("value")),
        "nonzero_cells": lambda s, d: R.nonzero_cells(TD.raster_cells(s, d)),
        "zonal_mean": lambda s, d: zonal_means(s, d).select(
            "airport_id", F.round("bird_population", 6).alias("bird_population"), "n_pixels"),
        "training_table": lambda s, d: training_table(s, d).select(
            "airport_id", F.round("bird_population", 6).alias("bird_population"), "bird_strike_count",
            "flight_count", F.round("bird_flight_ratio", 6).alias("bird_flight_ratio")),
        "season_filter_exclusive": season_filter_exclusive,
        "season_filter_inclusive": season_filter_inclusive,
        "hhmm_to_minutes": hhmm_minutes,
        "parse_strike_times": parse_strike_times,
        "clean_coordinates": clean_coordinates,
        "airport_keys": airport_keys,
        "text_fields": text_fields,
        "first_rows": first_rows,
        "top_n": lambda s, d: T.top_n(supplier_lines(s, d), "line_count", ["l_suppkey"], 50),
        "bottom_n": lambda s, d: T.top_n(supplier_lines(s, d), "line_count", ["l_suppkey"], 50, ascending=True),
        "top_and_bottom": lambda s, d: T.top_and_bottom(supplier_lines(s, d), "line_count", ["l_suppkey"], 50),
        "missing_codes": missing_codes,
        "missing_timezones": missing_timezones,
        "nearest_timezone": airport_timezones,
        "near_sunset_flights_tz": near_flights_tz,
        "dataset_profile": lambda s, d: QL.profile(TD.read_table(s, d, "events")),
        "near_sunset_flights": near_flights,
        "flight_frequencies": frequencies,
        "top_airports": top_airports,
        "bottom_airports": lambda s, d: T.top_n(frequencies(s, d), "flight_count", T.GROUP_KEY, 50, ascending=True),
        "top_and_bottom_airports": lambda s, d: T.top_and_bottom(frequencies(s, d), "flight_count", T.GROUP_KEY, 50),
        "solar_table": lambda s, d: T.solar_table(TD.flights(s, d), TD.airports(s, d), START, END,
                                                  offset="longitude"),
        "solar_calendar": lambda s, d: T.calendar_solar_table(TD.sites(s, d), START, END, TD.TEST_FLIGHT_YEARS,
                                                              offset="longitude"),
        "near_sunset_strikes": near_strikes,
        "strike_counts": strike_counts,
        "strike_rejects": lambda s, d: T.strike_rejects(TD.strikes(s, d)),
        "strike_per_flight": lambda s, d: T.strike_per_flight(frequencies(s, d), strike_counts(s, d)),
        "strike_ratio_left": lambda s, d: T.strike_ratio_left(frequencies(s, d), strike_counts(s, d)),
    }
