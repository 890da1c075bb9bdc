import numpy as np
import pytest

from sunset_engine.operators import nearest as N
from sunset_engine.operators.timezones import US_TIMEZONE_POINTS, nearest_timezone, timezone_points

PLACES = "site long, latitude_deg double, longitude_deg double, lat string"


def brute(sites, points):
    """Nearest of ``points`` (name, lat, lon) for each site, by the haversine formula; the smaller name wins a tie."""
    names = np.array([p[0] for p in points])
    la, lo = np.radians([p[1] for p in points]), np.radians([p[2] for p in points])
    out = {}
    for lat, lon in sites:
        a, o = np.radians(lat), np.radians(lon)
        h = np.sin((la - a) / 2) ** 2 + np.cos(a) * np.cos(la) * np.sin((lo - o) / 2) ** 2
        d = 2 * np.arcsin(np.minimum(1, np.sqrt(h)))
        near = names[d <= d.min() + 1e-12]
        out[lat, lon] = (set(near.tolist()), float(np.degrees(d.min())))
    return out


def check(spark, sites, points):
    s = spark.createDataFrame([(i, float(a), float(o), "x") for i, (a, o) in enumerate(sites)], PLACES).repartition(3)
    p = spark.createDataFrame([(n, float(a), float(o)) for n, a, o in points], "name string, lat double, lon double")
    want = brute(sites, points)
    got = {(r.latitude_deg, r.longitude_deg): (r.name, r.degrees) for r in N.nearest(s, p, "name").collect()}
    assert set(got) == set(want)
    for k, (name, d) in got.items():
        assert name in want[k][0] and d == pytest.approx(want[k][1], abs=1e-6), k
    return got


def test_many_points_against_brute_force(spark):
    """100,000 points, most of them in a few dense towns; sites everywhere."""
    draw = np.random.default_rng(1)
    towns = draw.uniform((-80, -180), (80, 180), (30, 2))
    dense = towns[draw.integers(0, 30, 90_000)] + draw.normal(0, 0.5, (90_000, 2))
    wide = np.column_stack([np.degrees(np.arcsin(draw.uniform(-1, 1, 10_000))), draw.uniform(-180, 180, 10_000)])
    spots = np.clip(np.vstack([dense, wide]), (-90, -180), (90, 180))
    points = [(f"p{i}", a, o) for i, (a, o) in enumerate(spots)]
    sites = [*map(tuple, draw.uniform((-90, -180), (90, 180), (300, 2)).tolist()), *map(tuple, (spots[:200] + 0.01).clip((-90, -180), (90, 180)).tolist())]
    check(spark, sites, points)


def test_poles_date_line_and_far_points(spark):
    points = [("north", 89.5, 10.0), ("west", 0.5, -179.9), ("east", -20.0, 179.0), ("south", -89.0, -170.0), ("mid", 45.0, 0.0)]
    sites = [(90.0, 0.0), (90.0, 180.0), (-90.0, 55.0), (0.0, 180.0), (0.0, -180.0), (0.4, 179.95), (89.9, -170.0), (89.0, 190.0 - 360), (-45.0, 90.0), (10.0, 95.0), (45.0, 0.0), (-89.5, 10.0)]
    check(spark, sites, points)


def test_one_point_and_antipodes(spark):
    check(spark, [(0.0, 0.0), (0.0, 180.0), (-10.0, 170.0), (10.0, -10.0)], [("only", 10.0, -10.0)])


def test_ties_take_the_smaller_name_and_points_at_one_place_count_once(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0, "x"), (2, 0.0, 0.0, "y"), (3, 5.0, 5.0, "z")], PLACES)
    p = spark.createDataFrame([("b", 0.0, 1.0), ("a", 0.0, -1.0), ("d", 5.0, 5.0), ("c", 5.0, 5.0), (None, 0.0, 0.0)], "name string, lat double, lon double")
    assert {(r.latitude_deg, r.name) for r in N.nearest(s, p, "name").collect()} == {(0.0, "a"), (5.0, "c")}
    assert sorted((r.site, r.name, r.lat) for r in N.with_nearest(s, p, "name").collect()) == [(1, "a", "x"), (2, "a", "y"), (3, "c", "z")]


def test_odd_rows(spark):
    s = spark.createDataFrame([(1, None, 0.0, "x"), (2, float("nan"), 1.0, "x"), (3, 1.0, float("inf"), "x"), (4, 95.0, 0.0, "x"), (5, 1.0, 361.0, "x")], PLACES)
    p = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 1.0), ("c", 2.0, float("nan"))], "name string, lat double, lon double")
    assert sorted((r.site, r.name) for r in N.with_nearest(s, p, "name").collect()) == [(1, None), (2, None), (3, None), (4, None), (5, "a")]
    assert N.nearest(s, p.limit(0), "name").collect() == [] and N.nearest(s.limit(0), p, "name").collect() == []


def test_zones_equal_the_expression(spark):
    """The inline reference points give the same zones by the index as by the expression over all of them."""
    draw = np.random.default_rng(2)
    rows = [(i, *map(float, x), "x") for i, x in enumerate(draw.uniform((15, -170), (72, -60), (200, 2)))]
    s = spark.createDataFrame(rows, PLACES)
    points = timezone_points(spark)
    assert points.count() == len(US_TIMEZONE_POINTS)
    got = {r.site: r.timezone for r in N.with_nearest(s, points, "timezone").collect()}
    assert got == {r.site: r.tz for r in s.select("site", nearest_timezone("latitude_deg", "longitude_deg").alias("tz")).collect()}
