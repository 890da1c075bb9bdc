import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sunset_engine.functions import geo as G
from sunset_engine.operators import raster as R
from sunset_engine.operators.joins import materialize

AP = "airport_id string, latitude_deg double, longitude_deg double"
# Public airport coordinates (degrees).
SEVEN = [("DEN", 39.861656, -104.673178), ("ATL", 33.6367, -84.428101), ("SHV", 32.446602, -93.8256),
         ("ABQ", 35.040199, -106.609001), ("MLI", 41.448502, -90.5075), ("ABE", 40.652100, -75.440804),
         ("AGS", 33.369900, -81.964500)]


def test_albers_origin_and_round_trip(spark):
    a = spark.createDataFrame([("O", 23.0, -96.0)] + SEVEN, AP)
    p = R.project_airports(a)
    o = p.where("airport_id = 'O'").first()
    assert abs(o.x) < 1e-6 and abs(o.y) < 1e-6
    for r in R.round_trip(p).collect():
        assert abs(r.lat_back - r.latitude_deg) < 1e-9 and abs(r.lon_back - r.longitude_deg) < 1e-9


def test_vincenty_destination_distance(spark):
    df = spark.createDataFrame([(39.86, -104.67)], "lat double, lon double")
    steps = G.destination_steps("lat", "lon", 45.0, 8046.72, "lat2", "lon2", "_v")
    r = G.apply_steps(df, steps, "_v").first()
    # haversine on the mean sphere agrees with the ellipsoidal 5 miles to within 0.5 %
    p1, p2 = math.radians(r.lat), math.radians(r.lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(r.lon2 - r.lon) / 2) ** 2
    d = 2 * 6371008.8 * math.asin(math.sqrt(h))
    assert abs(d - 8046.72) / 8046.72 < 5e-3
    assert r.lat2 > r.lat and r.lon2 > r.lon


def test_zone_pixel_counts_of_seven_airports(spark):
    # Pixel counts consistent with the published training table's bird_population fractions.
    pix = R.zone_pixels(R.airport_zones(spark.createDataFrame(SEVEN, AP)))
    got = {r.airport_id: r["count"] for r in pix.groupBy("airport_id").count().collect()}
    assert got == {"DEN": 136, "ATL": 131, "SHV": 145, "ABQ": 138, "MLI": 146, "ABE": 138, "AGS": 138}


def test_airport_outside_grid_has_no_zone(spark):
    a = spark.createDataFrame([("ANC", 61.17, -149.99), ("DEN", 39.861656, -104.673178)], AP)
    assert [r.airport_id for r in R.airport_zones(a).collect()] == ["DEN"]


def _zone(spark, corners, grid=(10, 10)):
    cols = {f"c{k}_{v}": corners[k][i] for k in range(4) for i, v in enumerate("xy")}
    row = {"airport_id": "Z", "latitude_deg": 0.0, "longitude_deg": 0.0, "col": 1, "row": 1, **cols}
    schema = "airport_id string, latitude_deg double, longitude_deg double, col int, row int, " + \
        ", ".join(f"{c} int" for c in cols)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_edge_pixels_are_inside_and_off_grid_pixels_ignored(spark):
    bounds = (0.0, 0.0, 10.0, 10.0)
    # NE, SE, SW, NW corners in pixel space (row grows downward)
    z = _zone(spark, [(3, 0), (3, 3), (0, 3), (0, 0)])
    pix = R.zone_pixels(z, bounds=bounds, resolution=1.0)
    assert pix.count() == 16  # the full 4 x 4 box, edges included
    off = _zone(spark, [(1, -3), (1, 1), (-3, 1), (-3, -3)])
    pix = R.zone_pixels(off, bounds=bounds, resolution=1.0).collect()
    assert sorted((r.row, r.col) for r in pix) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_pixel_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-2356500.0, 3172500.0), (-2355500.0, 3171500.0)], "x double, y double")
    out = G.apply_steps(df, G.pixel_steps("x", "y", "col", "row")).collect()
    assert [(r.col, r.row) for r in out] == [(0, 0), (0, 0)]


def test_normalisation_constant_and_sparse(spark):
    bounds, res = (0.0, 0.0, 2.0, 2.0), 1.0  # 2 x 2 grid
    full = spark.createDataFrame([(0, 0, 5.0), (0, 1, 5.0), (1, 0, 5.0), (1, 1, 5.0)], "row int, col int, value double")
    assert {r.value for r in R.normalized_cells(full, bounds, res).collect()} == {5.0}
    sparse = spark.createDataFrame([(0, 0, 4.0), (0, 1, float("nan")), (1, 0, None)],
                                   "row int, col int, value double")
    vals = sorted(r.value for r in R.normalized_cells(sparse, bounds, res).collect())
    assert vals == [0.0, 0.0, 1.0]
    assert sorted((r.row, r.col) for r in R.nonzero_cells(sparse).collect()) == [(0, 0)]


def test_zonal_mean_counts_absent_cells_as_zero(spark):
    bounds = (0.0, 0.0, 10.0, 10.0)
    z = _zone(spark, [(1, 0), (1, 1), (0, 1), (0, 0)])  # 2 x 2 pixels at the corner
    cells = spark.createDataFrame([(0, 0, 2.0), (5, 5, 4.0)], "row int, col int, value double")
    r = R.zonal_mean(z, cells, bounds=bounds, resolution=1.0).first()
    # min 0 (absent cells), max 4: pixel (0,0) -> 0.5, three absent pixels -> 0
    assert r.n_pixels == 4 and r.bird_population == pytest.approx(0.125)


def test_presence_raster(spark):
    z = R.airport_zones(spark.createDataFrame(SEVEN + [("DUP", 39.861656, -104.673178)], AP))
    pres = R.presence_raster(z)
    assert pres.count() == 7 and {r.value for r in pres.collect()} == {1.0}
    assert dict(pres.dtypes)["value"] == "float"
    assert z.select(F.max("col")).first()[0] < G.grid_shape()[1]


def test_nodata_value_counts_as_zero(spark):
    bounds = (0.0, 0.0, 2.0, 2.0)
    cells = spark.createDataFrame([(0, 0, -9999.0), (0, 1, 2.0), (1, 0, 4.0), (1, 1, 0.0)],
                                  "row int, col int, value double")
    plain = sorted(r.value for r in R.normalized_cells(cells, bounds, 1.0).collect())
    masked = sorted(r.value for r in R.normalized_cells(cells, bounds, 1.0, nodata=-9999.0).collect())
    assert plain[0] == 0.0 and plain[-1] == 1.0 and plain[1] > 0.99  # -9999 stretches the range
    assert masked == [0.0, 0.0, 0.5, 1.0]


def test_zonal_plan_sums_cells_without_pixels(spark):
    """Cells meet the zones' ends in one shuffle by row and tile: no row per pixel, no join of the cells."""
    z = R.airport_zones(spark.createDataFrame(SEVEN, AP))
    cells = spark.range(0, 2000).selectExpr("cast(1200 + id % 100 as int) as row",
                                            "cast(1600 + id div 100 as int) as col", "cast(id % 3 as double) as value")
    plan = R.interval_sums(materialize(R.zone_intervals(z), "spans"), cells)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(row" in plan and "Window" in plan and "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("hashpartitioning(row") == 1
    plan = R.zonal_mean(z, cells)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan  # raster min/max as a scalar subquery
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_vincenty_published_case(spark):
    """Flinders Peak to Buninyong, the worked example of the Australian geodetic datum manual (GRS80)."""
    from sunset_engine.functions.geo import destination_steps
    from sunset_engine.functions.steps import apply_steps

    dms = lambda d, m, s: d + m / 60 + s / 3600
    df = spark.createDataFrame([(-dms(37, 57, 3.7203), dms(144, 25, 29.5244))], "lat double, lon double")
    r = apply_steps(df, destination_steps("lat", "lon", dms(306, 52, 5.37), 54972.271, "lat2", "lon2", "_t"), "_t").first()
    assert abs(r.lat2 + dms(37, 39, 10.1561)) < 1e-7 and abs(r.lon2 - dms(143, 55, 35.3839)) < 1e-7


def test_albers_is_equal_area_and_true_on_its_parallels(spark):
    import math

    step = 1e-4
    points = [(lat + i * step, lon + j * step) for lat, lon in ((29.5, -100.0), (45.5, -80.0), (37.0, -96.0)) for i in (0, 1) for j in (0, 1)]
    rows = [("o", 23.0, -96.0)] + [(str(k), la, lo) for k, (la, lo) in enumerate(points)]
    df = spark.createDataFrame(rows, "airport_id string, latitude_deg double, longitude_deg double")
    xy = {r.airport_id: (r.x, r.y) for r in R.project_airports(df).collect()}
    assert abs(xy["o"][0]) < 1e-6 and abs(xy["o"][1]) < 1e-6
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    for k in range(3):
        p, q, s, t = (xy[str(4 * k + i)] for i in range(4))                 # (lat, lon), lon + step, lat + step, both
        lat = math.radians(points[4 * k][0] + step / 2)
        w = 1 - e2 * math.sin(lat) ** 2
        east, north = a / math.sqrt(w) * math.cos(lat) * math.radians(step), a * (1 - e2) / w ** 1.5 * math.radians(step)
        area = abs((t[0] - p[0]) * (s[1] - q[1]) - (t[1] - p[1]) * (s[0] - q[0])) / 2
        assert abs(area / (east * north) - 1) < 1e-6
        if k < 2:                                                           # standard parallels keep lengths
            assert abs(math.dist(p, q) / east - 1) < 1e-5


def test_cells_off_the_grid_play_no_part(spark):
    cells = spark.createDataFrame([(0, 0, 2.0), (1, 1, 4.0), (5, 5, 100.0), (-1, 0, -50.0)], "row int, col int, value double")
    bounds = (0.0, 0.0, 2.0, 2.0)
    got = {(r.row, r.col): r.value for r in R.normalized_cells(cells, bounds, 1.0).collect()}
    assert got == {(0, 0): 0.5, (1, 1): 1.0}
    zone = spark.createDataFrame([("Z", 0.0, 0.0, 0, 0, 1, 0, 1, 1, 0, 1, 0, 0)],
                                 "airport_id string, latitude_deg double, longitude_deg double, col int, row int, "
                                 "c0_x int, c0_y int, c1_x int, c1_y int, c2_x int, c2_y int, c3_x int, c3_y int")
    m = R.zonal_mean(zone, cells, bounds, 1.0).first()
    assert (m.n_pixels, m.bird_population) == (4, 0.375)


def test_zonal_mean_reads_the_raster_once(spark, tmp_dir):
    spark.createDataFrame([(r, c, float(r + c)) for r in range(9) for c in range(9)], "row int, col int, value double").write.parquet(f"{tmp_dir}/cells")
    zone = spark.createDataFrame([("Z", 0.0, 0.0, 5, 5, 7, 2, 7, 7, 2, 7, 2, 2), ("Y", 1.0, 0.0, 5, 5, 8, 1, 8, 6, 3, 6, 3, 1)],
                                 "airport_id string, latitude_deg double, longitude_deg double, col int, row int, "
                                 "c0_x int, c0_y int, c1_x int, c1_y int, c2_x int, c2_y int, c3_x int, c3_y int")
    out = R.zonal_mean(zone, spark.read.parquet(f"{tmp_dir}/cells"), (0.0, 0.0, 9.0, 9.0), 1.0)
    assert {r.airport_id: r.n_pixels for r in out.collect()} == {"Z": 36, "Y": 36}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "SortMergeJoin" not in plan


def test_intervals_hold_the_same_pixels(spark):
    """Random quadrilaterals, thin, flat, off the grid and single pixels among them."""
    draw = random.Random(3)
    rows = []
    for i in range(400):
        size = draw.choice([0, 1, 3, 12])
        x, y = draw.randint(-4, 44), draw.randint(-4, 34)
        ring = [(size, -size), (size, size), (-size, size), (-size, -size)]
        if i % 3 == 0:
            ring = [(draw.randint(-size, size), draw.randint(-size, size)) for _ in range(4)]
        rows.append((f"A{i}", float(i), 0.0, *[v for a, b in ring for v in (x + a, y + b)]))
    z = spark.createDataFrame(rows, "airport_id string, latitude_deg double, longitude_deg double, " + ", ".join(f"c{k}_{v} int" for k in range(4) for v in ("x", "y")))
    grid = dict(bounds=(0.0, 0.0, 40.0, 30.0), resolution=1.0)
    want = {tuple(r) for r in R.zone_pixels(z, **grid).select("airport_id", "row", "col").collect()}
    got = R.zone_intervals(z, **grid).collect()
    pixels = [(r.airport_id, x.row, c) for r in got for x in r.spans for c in range(x.first, x.last + 1)]
    assert len(pixels) == len(set(pixels)) and set(pixels) == want
    assert {r.airport_id: r.n_pixels for r in got if r.n_pixels} == Counter(p[0] for p in want)


@pytest.mark.parametrize("tile", [256, 5, 1])
def test_zonal_mean_by_running_sums(spark, monkeypatch, tile):
    monkeypatch.setattr(R, "TILE", tile)
    draw = random.Random(4)
    zones = []
    for i in range(60):
        x, y, n = draw.randint(0, 39), draw.randint(0, 29), draw.choice([0, 2, 6, 50])
        zones.append((f"A{i}", float(i), 0.0, x + n, y - n, x + n, y + n, x - n, y + n, x - n, y - n))
    z = spark.createDataFrame(zones + zones[:5], "airport_id string, latitude_deg double, longitude_deg double, " + ", ".join(f"c{k}_{v} int" for k in range(4) for v in ("x", "y")))
    cells = {(draw.randint(-2, 31), draw.randint(-2, 41)): draw.choice([None, float("nan"), 0.0, draw.random() * 9 - 2]) for _ in range(500)}
    grid = dict(bounds=(0.0, 0.0, 40.0, 30.0), resolution=1.0)
    df = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()], "row int, col int, value double")
    got = {r.airport_id: (r.bird_population, r.n_pixels) for r in R.zonal_mean(z, df, **grid).collect()}
    value = {k: 0.0 if v is None or math.isnan(v) else v for k, v in cells.items() if 0 <= k[0] < 30 and 0 <= k[1] < 40}
    lo, hi = min(0.0, *value.values()), max(0.0, *value.values())
    own = Counter(r.airport_id for r in R.zone_pixels(z.dropDuplicates(["airport_id"]), **grid).collect())
    sums = Counter()
    for r in R.zone_pixels(z.dropDuplicates(["airport_id"]), **grid).collect():
        sums[r.airport_id] += value.get((r.row, r.col), 0.0)
    assert set(got) == set(own)
    for k, (mean, n) in got.items():
        assert n == own[k] and mean == pytest.approx((sums[k] / n - lo) / (hi - lo), abs=1e-9)


@pytest.mark.parametrize("query", [lambda z: z, R.zone_labels, R.zone_outline, R.zone_pixels])
def test_zone_code_is_compiled_and_dealt_to_many_tasks(spark, query):
    sites = spark.range(3000).coalesce(1).select(F.col("id").cast("string").alias("airport_id"), (27.3 + F.col("id") * 37 % 2000 / 100).alias("latitude_deg"),
                                                 (-120.7 + F.col("id") * 53 % 4900 / 100).alias("longitude_deg"))
    found = query(R.airport_zones(sites))
    assert found.rdd.getNumPartitions() > 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")              # its plans are compiled as they run
    try:
        plan = query(R.airport_zones(sites))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) <= 8000                                # the JVM compiles no larger method
