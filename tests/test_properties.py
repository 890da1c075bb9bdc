"""Property checks on small generated inputs (few examples each: every one is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sunset_engine.operators import quality as QL
from sunset_engine.operators import raster as R
from sunset_engine.operators import traffic as T

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
codes = st.sampled_from(["DEN", "ATL", "APA", "ORD", ""])


@SETTINGS
@given(st.lists(st.tuples(codes, codes, st.integers(0, 2400)), min_size=1, max_size=30))
def test_roles_are_origin_plus_destination(spark, rows):
    f = spark.createDataFrame([(i, dt.date(2019, 9, 1), o, d, f"{t}.0", f"{t}.0") for i, (o, d, t) in enumerate(rows)],
                              "event_id long, flight_date date, origin string, dest string, "
                              "dep_time string, arr_time string")
    roles = T.flight_roles(f)
    assert roles.count() == 2 * f.count()
    assert roles.where("role = 'origin'").count() == f.count()


@SETTINGS
@given(st.lists(st.tuples(st.floats(20, 55), st.floats(-130, -60)), min_size=1, max_size=20))
def test_albers_round_trip_is_identity(spark, pts):
    a = spark.createDataFrame([(str(i), la, lo) for i, (la, lo) in enumerate(pts)],
                              "airport_id string, latitude_deg double, longitude_deg double")
    worst = (R.round_trip(R.project_airports(a))
             .select(F.max(F.greatest(F.abs(F.col("lat_back") - F.col("latitude_deg")),
                                      F.abs(F.col("lon_back") - F.col("longitude_deg"))))).first()[0])
    assert worst < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.one_of(st.none(), st.floats(-50, 50))),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_normalised_values_in_unit_interval(spark, cells):
    df = spark.createDataFrame(cells, "row int, col int, value double")
    bounds = (0.0, 0.0, 10.0, 10.0)
    vals = [r.value for r in R.normalized_cells(df, bounds, 1.0).collect()]
    lo = min(min(v for _, _, v in cells if v is not None) if any(v is not None for *_, v in cells) else 0.0, 0.0)
    hi = max(max(v for _, _, v in cells if v is not None) if any(v is not None for *_, v in cells) else 0.0, 0.0)
    if hi > lo:
        assert all(-1e-12 <= v <= 1 + 1e-12 for v in vals)
    # zonal mean of a zone inside the grid lies within the normalised range
    zone = spark.createDataFrame([("Z", 0.0, 0.0, 5, 5, 7, 2, 7, 7, 2, 7, 2, 2)],
                                 "airport_id string, latitude_deg double, longitude_deg double, col int, row int, "
                                 "c0_x int, c0_y int, c1_x int, c1_y int, c2_x int, c2_y int, c3_x int, c3_y int")
    m = R.zonal_mean(zone, df, bounds, 1.0).first()
    assert m.n_pixels == 36
    if hi > lo:
        assert -1e-12 <= m.bird_population <= 1 + 1e-12


@SETTINGS
@given(st.lists(st.integers(0, 10**6), min_size=6, max_size=40, unique=True), st.integers(1, 3))
def test_top_and_bottom_disjoint(spark, counts, n):
    df = spark.createDataFrame([(f"A{i}", 0.0, 0.0, c) for i, c in enumerate(counts)],
                               "airport_id string, latitude_deg double, longitude_deg double, flight_count long")
    top = {r.airport_id for r in T.top_n(df, "flight_count", T.GROUP_KEY, n).collect()}
    bottom = {r.airport_id for r in T.top_n(df, "flight_count", T.GROUP_KEY, n, ascending=True).collect()}
    assert len(top) == n and len(bottom) == n and not (top & bottom)


@SETTINGS
@given(st.lists(codes, min_size=1, max_size=30), st.lists(codes, max_size=5))
def test_anti_and_semi_join_partition_the_codes(spark, used, known):
    u = spark.createDataFrame([(c,) for c in used], "code string")
    k = spark.createDataFrame([(c,) for c in known] or [("ZZZ",)], "code string")
    missing = {r.code for r in QL.missing_codes(u, k).collect()}
    present = {r.code for r in u.distinct().join(k.distinct(), "code", "left_semi").collect()}
    assert missing | present == set(used) and not (missing & present)
