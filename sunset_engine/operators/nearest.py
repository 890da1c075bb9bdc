"""Nearest point on the sphere by a cell index.

Points and sites meet in cells of latitude and longitude. A site looks into all cells that a
circle around it touches; a point found within the circle's radius is certainly the nearest one if
no other is nearer. Sites that found none go on with a circle and cells twice as large, so
every site ends, in some round, with the exact answer. Each round is one equi-join on
cells over the sites still open. The first radius is set by the points themselves: it
halves until no cell holds more than ``CELL_POINTS`` of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunset_engine.operators.joins import broadcast_if_bounded, materialize
from sunset_engine.operators.timezones import central_angle

# Radii in degrees: every one is half of the one before. At 180 degrees a circle is the whole sphere.
RADII = [180.0 / 2 ** k for k in range(15)]
CELL_POINTS = 32
# A point this close to the circle's edge is not yet certain: angles are rounded.
MARGIN = 1e-9


def _row(lat: Column, size: float) -> Column:
    return F.floor((lat + 90.0) / size)


def _column(lon: Column, size: float) -> Column:
    """Longitudes are taken around the globe, so that 180 and -180 are one."""
    return F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / size)


def _cells(lat: Column, lon: Column, radius: float) -> Column:
    """The cells of size ``radius`` that a circle of that radius around a place touches, as array<struct<r, c>>."""
    columns = round(360.0 / radius)
    near_pole = F.abs(lat) + radius >= 90.0
    reach = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(radius))) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-12))))) + 1e-7
    rows = F.sequence(F.greatest(_row(lat - radius, radius), F.lit(0)), F.least(_row(lat + radius, radius), F.lit(round(180.0 / radius))))
    # All columns where the circle holds a pole; else those from its west to its east, which may pass 180 degrees.
    west, east = F.floor((lon + 180.0 - reach) / radius), F.floor((lon + 180.0 + reach) / radius)
    all_ = near_pole | (east - west + 1 >= columns)
    span = F.when(all_, F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))).otherwise(
        F.transform(F.sequence(west, east), lambda c: F.pmod(c, F.lit(columns))))
    return F.flatten(F.transform(rows, lambda r: F.transform(span, lambda c: F.struct(r.alias("r"), c.alias("c")))))


def first_radius(points: DataFrame, lat: str = "lat", lon: str = "lon") -> int:
    """Place in ``RADII`` of the largest radius whose cells hold few points each; one pass over the points."""
    sizes = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _row(F.col(lat), s).alias("r"), _column(F.col(lon), s).alias("c")) for k, s in enumerate(RADII)]))
    most = points.select(sizes.alias("x")).groupBy("x").count().groupBy("x.k").agg(F.max("count").alias("most")).collect()     # a row per radius
    return min((r.k for r in most if r.most <= CELL_POINTS), default=len(RADII) - 1)


def nearest(sites: DataFrame, points: DataFrame, value: str, lat: str = "latitude_deg", lon: str = "longitude_deg", point_lat: str = "lat", point_lon: str = "lon") -> DataFrame:
    """One row per distinct place of ``sites``: (lat, lon, ``value`` of the nearest of ``points``, ``degrees`` to it).

    Great-circle distance (haversine); of points equally near, the smallest value counts. Places without two finite
    coordinates, or with a latitude beyond the poles, have no row; such points are not used. Without points there are no rows.
    """
    def placed(df: DataFrame, a: str, o: str, *more: Column) -> DataFrame:
        x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{o}`").cast("double")
        return df.select(x.alias("lat"), y.alias("lon"), *more).where("abs(lat) <= 90 and abs(lon) < 1e6")       # no NaN, no infinity

    # Points at one place count once, so that a cell's rows are places.
    known = materialize(placed(points, point_lat, point_lon, F.col(f"`{value}`").alias("value")).where("value is not null").groupBy("lat", "lon").agg(F.min("value").alias("value")), "nearest-points")
    open_ = materialize(placed(sites, lat, lon).distinct(), "nearest-sites")
    kind = known.schema["value"].dataType
    found: list[DataFrame] = []
    if not known.isEmpty():
        for radius in reversed(RADII[:first_radius(known) + 1]):
            at = known.select(F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "value", _row(F.col("lat"), radius).alias("r"), _column(F.col("lon"), radius).alias("c"))
            looked = open_.select("lat", "lon", F.explode(_cells(F.col("lat"), F.col("lon"), radius)).alias("x")).select("lat", "lon", F.col("x.r").alias("r"), F.col("x.c").alias("c"))
            best = (looked.join(at, ["r", "c"]).select("lat", "lon", F.struct(central_angle("lat", "lon", "p_lat", "p_lon").alias("angle"), "value").alias("b"))
                    .groupBy("lat", "lon").agg(F.min("b").alias("b")))
            sure = best if radius == RADII[0] else best.where(F.degrees("b.angle") <= radius - MARGIN)
            done = materialize(sure.select("lat", "lon", "b.value", F.degrees("b.angle").alias("degrees")), "nearest-found")
            found.append(done)
            open_ = materialize(open_.join(done.select("lat", "lon"), ["lat", "lon"], "left_anti"), "nearest-sites")
            if open_.isEmpty():
                break
    out = reduce(DataFrame.unionAll, found) if found else sites.sparkSession.createDataFrame([], "lat double, lon double, value string, degrees double")
    return out.select(F.col("lat").alias(lat), F.col("lon").alias(lon), F.col("value").cast(kind).alias(value), "degrees")


def with_nearest(sites: DataFrame, points: DataFrame, value: str, lat: str = "latitude_deg", lon: str = "longitude_deg", point_lat: str = "lat", point_lon: str = "lon") -> DataFrame:
    """``sites`` with the ``value`` of the nearest point; NULL where there is no place or no point. Places are looked up once each."""
    places = nearest(sites, points, value, lat, lon, point_lat, point_lon).drop("degrees").withColumnsRenamed({lat: "_lat", lon: "_lon"})
    same = (F.col(f"`{lat}`").cast("double") == F.col("_lat")) & (F.col(f"`{lon}`").cast("double") == F.col("_lon"))
    return sites.drop(value).join(broadcast_if_bounded(places), same, "left").drop("_lat", "_lon")
