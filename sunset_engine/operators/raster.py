"""Airport zones on a projected grid and zonal means of a bird-density raster.

The raster is a *sparse* cell table ``(row int, col int, value double)``: cells
that are absent hold 0, as do NULL and NaN values (P15). A dense 4614 x 2900
grid is 13.4 M cells; a sparse table stores only the occupied ones, and every
operator below accounts for the implicit zeros exactly.

A table has one row per cell; rows outside the grid play no part.

Plan shape of ``zonal_mean``:

    airports -> Albers -> 4 Vincenty corners -> column intervals by row    (narrow, per airport)
      -> two rows for each interval and tile of columns
    cells, scanned once, and these rows                                     (one shuffle by row and tile)
      -> running sum by column within row and tile
      -> partial sum/count/min/max per zone and for the grid -> tiny shuffle -> final
    the grid's min and max come from that same aggregate
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunset_engine.functions.columns import finite, nan_to_zero
from sunset_engine.functions.geo import (GRID_BOUNDS, GRID_RESOLUTION, METRES_PER_MILE, ZONE_MILES,
                                         albers_forward_steps, albers_inverse_steps, apply_steps, grid_shape,
                                         pixel_steps, zone_corner_steps)
from sunset_engine.functions.steps import computed, where_computed
from sunset_engine.operators.joins import materialize, spread

ZONE_KEY = ["airport_id", "latitude_deg", "longitude_deg"]
# Columns of the grid that share a running sum.
TILE = 256
# Order at one column: an interval's first end, the cell, an interval's last end.
BEGIN, CELL, END = 0, 1, 2


def project_airports(airports: DataFrame) -> DataFrame:
    """Projected ``x``/``y`` metres; rows with missing or non-finite coordinates dropped."""
    a = airports.where(F.col("latitude_deg").isNotNull() & F.col("longitude_deg").isNotNull())
    a = apply_steps(a, albers_forward_steps("latitude_deg", "longitude_deg", "x", "y", "_pa_"), "_pa_")
    return where_computed(a, finite("x") & finite("y"))


def round_trip(projected: DataFrame) -> DataFrame:
    """Back from projected metres to degrees: ``lat_back``/``lon_back``."""
    return apply_steps(projected, albers_inverse_steps("x", "y", "lat_back", "lon_back", "_pi_"), "_pi_")


def airport_zones(airports: DataFrame, zone_miles: float = ZONE_MILES, bounds=GRID_BOUNDS,
                  resolution: float = GRID_RESOLUTION) -> DataFrame:
    """One zone per airport inside the grid: its pixel and 4 corner pixels.

    Columns: airport_id, latitude_deg, longitude_deg, col, row, c{k}_x, c{k}_y for k = 0..3,
    corners in bearing order 45, 135, 225, 315 degrees. Corners start from the
    airport's own coordinates; projecting there and back (``round_trip``) returns
    them to within 1e-12 degrees, so that detour is left out here.
    """
    height, width = grid_shape(bounds, resolution)
    a = project_airports(spread(airports.select(*ZONE_KEY)))
    a = apply_steps(a, pixel_steps("x", "y", "col", "row", bounds, resolution)).drop("x", "y")
    a = where_computed(a, (F.col("row") >= 0) & (F.col("row") < height) & (F.col("col") >= 0) & (F.col("col") < width))
    for k in range(4):
        steps = zone_corner_steps("latitude_deg", "longitude_deg", zone_miles * METRES_PER_MILE, k, bounds, resolution)
        # Parts the chains by a column that every query needs, so that corners nobody asks for are still left out.
        a = computed(apply_steps(a, steps, "_z"), "row")
    return a.select(*ZONE_KEY, "col", "row", *[f"c{k}_{v}" for k in range(4) for v in ("x", "y")])


def corners_array(zones: DataFrame) -> Column:
    """The 4 corners as ``array<struct<x int, y int>>``."""
    return F.array(*[F.struct(F.col(f"c{k}_x").alias("x"), F.col(f"c{k}_y").alias("y")) for k in range(4)])


def zone_outline(zones: DataFrame) -> DataFrame:
    """Closed outline: the 4 corners and the first one again, one row per point."""
    pts = F.concat(corners_array(zones), F.slice(corners_array(zones), 1, 1))
    return (zones.select("airport_id", F.posexplode(pts).alias("point", "p"))
            .select("airport_id", "point", F.col("p.x").alias("x"), F.col("p.y").alias("y")))


def zone_labels(zones: DataFrame) -> DataFrame:
    """Label anchor beside each airport pixel."""
    return zones.select("airport_id", (F.col("col") - 1.0).alias("label_x"), (F.col("row") - 7.0).alias("label_y"))


def _side(xa, ya, xb, yb) -> Column:
    cross = ((F.col(xb) - F.col(xa)) * (F.col("row") - F.col(ya))
             - (F.col(yb) - F.col(ya)) * (F.col("col") - F.col(xa)))
    return F.when(cross >= 0, F.lit(1)).otherwise(F.lit(-1))


def zone_pixels(zones: DataFrame, bounds=GRID_BOUNDS, resolution: float = GRID_RESOLUTION) -> DataFrame:
    """Grid pixels inside each zone: bounding box, then the 4 half-plane signs agree.

    Edges count as inside (``cross >= 0``); pixels off the grid are dropped.
    """
    height, width = grid_shape(bounds, resolution)
    xs = [F.col(f"c{k}_x") for k in range(4)]
    ys = [F.col(f"c{k}_y") for k in range(4)]
    z = zones.select(*ZONE_KEY, *[f"c{k}_{v}" for k in range(4) for v in ("x", "y")],
                     F.explode(F.sequence(F.least(*ys), F.greatest(*ys))).alias("row"),
                     F.least(*xs).alias("_x0"), F.greatest(*xs).alias("_x1"))
    z = z.select("*", F.explode(F.sequence("_x0", "_x1")).alias("col"))
    s = [_side("c2_x", "c2_y", "c3_x", "c3_y"), _side("c3_x", "c3_y", "c0_x", "c0_y"),
         _side("c0_x", "c0_y", "c1_x", "c1_y"), _side("c1_x", "c1_y", "c2_x", "c2_y")]
    inside = (s[0] == s[1]) & (s[1] == s[2]) & (s[2] == s[3])
    in_grid = (F.col("row") >= 0) & (F.col("row") < height) & (F.col("col") >= 0) & (F.col("col") < width)
    return z.where(inside & in_grid).select(*ZONE_KEY, "row", "col")


def _row_interval(row: Column, sign: int, width: int) -> Column:
    """First and last column of a grid row that lie on one side (``sign`` of the cross product) of all four edges.

    ``cross >= 0`` is a bound on the column that depends on the edge's direction; corners
    and rows are whole numbers, so the bounds are as exact as the half-plane test.
    """
    xs, ys = [F.col(f"c{k}_x") for k in range(4)], [F.col(f"c{k}_y") for k in range(4)]
    low, high, possible = [F.least(*xs), F.lit(0)], [F.greatest(*xs), F.lit(width - 1)], []
    for a, b in ((2, 3), (3, 0), (0, 1), (1, 2)):
        dx, dy = xs[b] - xs[a], ys[b] - ys[a]
        at = xs[a] + F.try_divide(dx * (row - ys[a]), dy)     # where the edge's line meets the row
        level = dx * (row - ys[a])                            # the cross product where the edge lies along the row
        if sign > 0:                                          # on the line counts as inside
            below, above, flat = F.floor(at), F.ceil(at), level >= 0
            high.append(F.when(dy > 0, below))
            low.append(F.when(dy < 0, above))
        else:
            below, above, flat = F.ceil(at) - 1, F.floor(at) + 1, level < 0
            high.append(F.when(dy < 0, below))
            low.append(F.when(dy > 0, above))
        possible.append((dy != 0) | flat)
    inside = possible[0] & possible[1] & possible[2] & possible[3]
    first, last = F.greatest(*low).cast("int"), F.least(*high).cast("int")      # both skip the bounds that are NULL
    return F.struct(row.alias("row"), first.alias("first"), F.when(inside, last).otherwise(first - 1).alias("last"))


def zone_intervals(zones: DataFrame, bounds=GRID_BOUNDS, resolution: float = GRID_RESOLUTION) -> DataFrame:
    """Each zone's pixels as intervals of columns: the zone key, ``n_pixels`` and ``spans`` (row, first, last).

    The same pixels as ``zone_pixels``, without a row for each: a zone has as many intervals as it is high, none if it
    is off the grid. Filter ``n_pixels`` on the written table only: pushed down, the filter repeats all formulas below it.
    """
    height, width = grid_shape(bounds, resolution)
    ys = [F.col(f"c{k}_y") for k in range(4)]
    low, high = F.greatest(F.least(*ys), F.lit(0)), F.least(F.greatest(*ys), F.lit(height - 1))
    rows = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    both = F.concat(F.transform(rows, lambda r: _row_interval(r, 1, width)), F.transform(rows, lambda r: _row_interval(r, -1, width)))
    found = zones.select(*ZONE_KEY, F.filter(both, lambda x: x["first"] <= x["last"]).alias("spans"))
    return found.select(*ZONE_KEY, F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1).alias("n_pixels"), "spans")


def presence_raster(zones: DataFrame) -> DataFrame:
    """Cells holding at least one airport, value 1."""
    return zones.select("row", "col").distinct().withColumn("value", F.lit(1.0).cast("float"))


def _value(nodata: float | None) -> Column:
    """Cell value with NULL, NaN and (when given) the ``nodata`` value read as 0."""
    v = F.col("value").cast("double")
    if nodata is not None:
        v = F.when(v == F.lit(float(nodata)), F.lit(None).cast("double")).otherwise(v)
    return nan_to_zero(v)


def _range_stats(cells: DataFrame, n_cells: int, nodata: float | None = None) -> Column:
    """Scalar subquery: struct(mn, mx) over the whole grid, implicit zero cells included (A5)."""
    v = _value(nodata)
    some_absent = F.count(F.lit(1)) < F.lit(n_cells)
    return cells.select(F.struct(
        F.when(some_absent, F.least(F.min(v), F.lit(0.0))).otherwise(F.min(v)).alias("mn"),
        F.when(some_absent, F.greatest(F.max(v), F.lit(0.0))).otherwise(F.max(v)).alias("mx"),
    ).alias("s")).scalar()


def _normalize(v: Column, stats: Column) -> Column:
    mn, mx = stats.getField("mn"), stats.getField("mx")
    return F.when(mx != mn, (v - mn) / (mx - mn)).otherwise(v)


def normalized_cells(cells: DataFrame, bounds=GRID_BOUNDS, resolution: float = GRID_RESOLUTION,
                     nodata: float | None = None) -> DataFrame:
    """Min-max normalised cells; unchanged when the raster is constant.

    Only NULL and NaN count as 0 by default, as in the reference; ``nodata``
    adds one more value that does.
    """
    height, width = grid_shape(bounds, resolution)
    cells = on_grid(cells, height, width)
    stats = _range_stats(cells, height * width, nodata)
    return cells.select("row", "col", _normalize(_value(nodata), stats).alias("value"))


def on_grid(cells: DataFrame, height: int, width: int) -> DataFrame:
    return cells.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))


def nonzero_cells(cells: DataFrame) -> DataFrame:
    """Cells whose value is neither 0, NULL nor NaN."""
    return cells.where(nan_to_zero("value") != 0).select("row", "col")


def interval_sums(spans: DataFrame, cells: DataFrame, nodata: float | None = None) -> DataFrame:
    """Sum of the cells in each zone's intervals, (z, s), and of the whole grid the count and range of the stored cells, (m, mn, mx) where ``z`` is NULL.

    Intervals are cut at the borders of tiles of ``TILE`` columns. Their ends are put among the
    cells of the same row and tile, and one running sum gives every end the sum of the cells before it: an
    interval's sum is its last end's less its first's. So a zone costs two rows for each grid row
    and tile it touches, not one for each pixel; the cells are read and shuffled once and nothing is broadcast.
    """
    key = F.struct(*ZONE_KEY)
    piece = F.explode(F.sequence(F.floor(F.col("x.first") / TILE), F.floor(F.col("x.last") / TILE)))
    cut = spans.select(key.alias("z"), F.explode("spans").alias("x")).select("z", "x", piece.alias("tile"))
    first, last = F.greatest(F.col("x.first"), F.col("tile") * TILE), F.least(F.col("x.last"), F.col("tile") * TILE + TILE - 1)
    # At one column: a first end, then the cell, then a last end.
    ends = F.inline(F.array(F.struct(first.alias("col"), F.lit(BEGIN).alias("part")), F.struct(last.alias("col"), F.lit(END).alias("part"))))
    marks = cut.select("z", F.col("x.row").alias("row"), "tile", ends).select("z", "row", "tile", F.col("col").cast("int").alias("col"), "part", F.lit(0.0).alias("v"))
    own = cells.select(F.lit(None).cast(marks.schema["z"].dataType).alias("z"), F.col("row").cast("int").alias("row"), F.floor(F.col("col") / TILE).alias("tile"),
                       F.col("col").cast("int").alias("col"), F.lit(CELL).alias("part"), _value(nodata).alias("v"))
    through = F.sum("v").over(Window.partitionBy("row", "tile").orderBy("col", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = own.unionByName(marks).withColumn("through", through)
    return summed.groupBy("z").agg(F.sum(F.when(F.col("part") == END, F.col("through")).when(F.col("part") == BEGIN, -F.col("through"))).alias("s"),
                                   F.count(F.lit(1)).alias("m"), F.min("v").alias("mn"), F.max("v").alias("mx"))


def zonal_mean(zones: DataFrame, cells: DataFrame, bounds=GRID_BOUNDS,
               resolution: float = GRID_RESOLUTION, nodata: float | None = None) -> DataFrame:
    """Mean normalised cell value over each zone's pixels (A6): ``bird_population``.

    Pixels without a stored cell contribute the normalised value of 0. Normalising is linear, so
    the mean is taken over raw values (``interval_sums``) and normalised at the end. Rows that repeat a zone share it.
    """
    height, width = grid_shape(bounds, resolution)
    # Zones and sums are used twice each. Written once, their long formulas are planned and computed once.
    spans = materialize(zone_intervals(zones.dropDuplicates(ZONE_KEY), bounds, resolution), "zone-spans").where("n_pixels > 0")
    sums = materialize(interval_sums(spans, on_grid(cells, height, width), nodata), "zone-sums")
    absent = F.col("m") < F.lit(height * width)
    grid = sums.where(F.col("z").isNull()).select(F.struct(
        F.when(absent, F.least("mn", F.lit(0.0))).otherwise(F.col("mn")).alias("mn"),
        F.when(absent, F.greatest("mx", F.lit(0.0))).otherwise(F.col("mx")).alias("mx")).alias("s")).scalar()
    mean = F.coalesce(F.col("s"), F.lit(0.0)) / F.col("n_pixels")
    scaled = F.when(grid.isNull(), mean).otherwise(_normalize(mean, grid))
    found = sums.where(F.col("z").isNotNull()).select("z", "s")               # a row per zone
    return spans.select(F.struct(*ZONE_KEY).alias("z"), "n_pixels").join(found, "z", "left").select("z.airport_id", scaled.alias("bird_population"), "n_pixels")
