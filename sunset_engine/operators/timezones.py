"""Point to time zone by nearest reference point.

The zone of an airport comes from a table of codes and zones where one is given
(``with_timezones``): that is exact. Without an entry, ``nearest_timezone`` takes the
closest of some 150 reference points, a per-row expression over a literal array: no join,
no shuffle. It is an approximation near zone borders; pass denser ``points`` there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col
from sunset_engine.operators.joins import broadcast_if_bounded

# Places in or near cities (latitude, longitude) with their IANA zone, for the
# United States and territories. Public knowledge; dense along the zone borders that have airports.
US_TIMEZONE_PLACES = {
    "America/New_York": [
        (40.7, -74.0), (42.4, -71.0), (43.6, -70.3), (44.8, -68.8), (44.5, -73.2), (42.9, -78.7), (40.5, -80.2),
        (38.9, -77.0), (36.9, -76.2), (35.9, -78.8), (35.2, -80.9), (32.9, -80.0), (33.6, -84.4), (32.1, -81.2),
        (30.5, -81.7), (25.8, -80.3), (28.0, -82.5), (30.4, -84.35), (28.4, -81.3), (26.5, -81.8), (35.8, -84.0),
        (35.0, -85.2), (38.0, -84.6), (39.05, -84.7), (40.0, -82.9), (41.4, -81.8), (38.4, -81.6), (37.3, -80.0),
        (32.5, -84.9),
    ],
    "America/Detroit": [
        (42.2, -83.35), (42.9, -85.5), (44.7, -85.6), (46.5, -84.4), (46.35, -87.4),
    ],
    "America/Indiana/Indianapolis": [
        (39.7, -86.3), (41.0, -85.2), (41.7, -86.3),
    ],
    "America/Kentucky/Louisville": [
        (38.2, -85.7),
    ],
    "America/Chicago": [
        (41.9, -87.8), (42.95, -87.9), (44.5, -88.1), (44.9, -93.2), (46.8, -92.2), (46.9, -96.8), (46.8, -100.75),
        (48.3, -101.3), (47.95, -97.2), (43.6, -96.7), (44.4, -100.3), (41.3, -95.9), (41.1, -100.7),
        (41.5, -93.7), (38.7, -90.4), (39.3, -94.7), (37.2, -93.4), (37.65, -97.4), (37.9, -100.7), (35.4, -97.6),
        (36.2, -95.9), (35.2, -101.7), (33.7, -101.8), (31.9, -102.2), (32.4, -99.7), (32.9, -97.0), (30.2, -97.7),
        (29.5, -98.5), (30.0, -95.3), (27.8, -97.5), (25.9, -97.4), (27.5, -99.5), (29.4, -100.9), (30.9, -102.9),
        (34.7, -92.2), (35.0, -90.0), (36.1, -86.7), (37.1, -88.8), (38.0, -87.5), (36.96, -86.4), (33.6, -86.75),
        (34.6, -86.8), (32.3, -86.4), (31.3, -85.45), (30.7, -88.2), (30.5, -87.2), (30.4, -85.8), (30.0, -90.3),
        (32.4, -93.8), (32.3, -90.1),
    ],
    "America/Denver": [
        (39.9, -104.7), (38.8, -104.7), (39.1, -108.5), (37.2, -107.8), (35.0, -106.6), (31.8, -106.4),
        (33.3, -104.5), (40.8, -112.0), (37.0, -113.5), (41.2, -104.8), (42.9, -106.5), (45.8, -108.5),
        (47.5, -111.4), (46.9, -114.1), (48.2, -106.6), (46.4, -105.9), (44.0, -103.1), (41.9, -103.6),
        (46.8, -102.8), (39.4, -101.7), (32.7, -103.2), (48.3, -114.3),
    ],
    "America/Boise": [
        (43.6, -116.2), (42.5, -114.5), (43.5, -112.1),
    ],
    "America/Phoenix": [
        (33.4, -112.0), (32.1, -110.9), (35.1, -111.7), (32.7, -114.6), (36.9, -111.4),
    ],
    "America/Los_Angeles": [
        (33.9, -118.4), (32.7, -117.2), (33.8, -116.5), (36.1, -115.2), (39.5, -119.8), (40.8, -115.8),
        (37.6, -122.4), (36.8, -119.7), (41.0, -124.1), (42.4, -122.9), (45.6, -122.6), (44.25, -121.15),
        (47.4, -122.3), (47.6, -117.5), (46.4, -117.0), (46.3, -119.1), (39.3, -114.8),
    ],
    "America/Anchorage": [
        (61.2, -150.0), (64.8, -147.9), (60.8, -161.8), (71.3, -156.8), (57.75, -152.5),
    ],
    "America/Juneau": [
        (58.35, -134.6), (55.4, -131.7),
    ],
    "America/Nome": [
        (64.5, -165.4),
    ],
    "America/Adak": [
        (51.9, -176.6),
    ],
    "Pacific/Honolulu": [
        (21.3, -157.9), (19.7, -155.0), (22.0, -159.3),
    ],
    "America/Puerto_Rico": [
        (18.4, -66.0),
    ],
    "America/St_Thomas": [
        (18.3, -65.0),
    ],
    "Pacific/Guam": [
        (13.5, 144.8), (15.1, 145.7),
    ],
    "Pacific/Pago_Pago": [
        (-14.3, -170.7),
    ],
}
US_TIMEZONE_POINTS = [(tz, la, lo) for tz, places in US_TIMEZONE_PLACES.items() for la, lo in places]


def central_angle(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle angle in radians between two points given in degrees (haversine)."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp = p2 - p1
    dl = F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(h))) * 2


def nearest_timezone(lat, lon, points=US_TIMEZONE_POINTS) -> Column:
    """IANA zone of the closest reference point; ties go to the smaller zone name."""
    pts = F.array(*[
        F.struct(F.lit(tz).alias("tz"), F.lit(float(la)).alias("la"), F.lit(float(lo)).alias("lo"))
        for tz, la, lo in points
    ])
    scored = F.transform(
        pts, lambda p: F.struct(central_angle(lat, lon, p["la"], p["lo"]).alias("d"), p["tz"].alias("tz")))
    return F.array_min(scored)["tz"]


def with_timezones(df: DataFrame, zones: DataFrame, key: Column | str = "airport_id") -> DataFrame:
    """``df`` with the ``timezone`` of its airport code from ``zones`` (code, timezone); NULL without an entry.

    Several entries of one code count once (the smallest zone name).
    """
    own = zones.where("code <> '' and timezone <> ''").groupBy("code").agg(F.min("timezone").alias("timezone"))
    own = broadcast_if_bounded(own.withColumnRenamed("code", "_zone_code"))
    return df.drop("timezone").join(own, as_col(key) == F.col("_zone_code"), "left").drop("_zone_code")


def timezone_points(spark: SparkSession) -> DataFrame:
    """The reference points as an inline relation (timezone, lat, lon)."""
    rows = ", ".join(f"('{tz}', {la}D, {lo}D)" for tz, la, lo in US_TIMEZONE_POINTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(timezone, lat, lon)")
