"""Map projection, geodesic destination and raster pixel math.

* Albers equal-area conic on WGS84 (Snyder, *Map Projections: A Working Manual*,
  USGS PP 1395), forward and inverse.
* Vincenty's direct geodesic problem (1975): the point at a distance and bearing.
* World to pixel coordinates on a north-up grid, truncating toward zero.

Formulas are Python functions over a math namespace ``m`` (see ``mathns``) and
are applied by ``steps.apply_steps``, one projection per dependency level: every
intermediate is computed once per row, all inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from sunset_engine.functions.steps import apply_steps  # noqa: F401  (re-exported for callers)

# WGS84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
WGS84_B = WGS84_A * (1.0 - WGS84_F)
WGS84_E2 = WGS84_F * (2.0 - WGS84_F)
WGS84_E = math.sqrt(WGS84_E2)

# The target grid's projection (Albers, standard parallels 29.5 and 45.5,
# origin 23 N 96 W) and grid (bounds in metres, 1 km cells).
ALBERS_LAT1 = 29.5
ALBERS_LAT2 = 45.5
ALBERS_LAT0 = 23.0
ALBERS_LON0 = -96.0
GRID_BOUNDS = (-2356000.0, 272000.0, 2258000.0, 3172000.0)  # xmin, ymin, xmax, ymax
GRID_RESOLUTION = 1000.0

# Zone corners at these bearings (degrees), 5 miles from the airport.
CORNER_BEARINGS = (45.0, 135.0, 225.0, 315.0)
ZONE_MILES = 5.0
METRES_PER_MILE = 1609.344

INVERSE_ITERATIONS = 5
VINCENTY_ITERATIONS = 3


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - WGS84_E2) * (s / (1 - WGS84_E2 * s * s)
                             - (1 / (2 * WGS84_E)) * math.log((1 - WGS84_E * s) / (1 + WGS84_E * s)))


def _m(phi: float) -> float:
    s = math.sin(phi)
    return math.cos(phi) / math.sqrt(1 - WGS84_E2 * s * s)


_m1, _m2 = _m(math.radians(ALBERS_LAT1)), _m(math.radians(ALBERS_LAT2))
_q1, _q2, _q0 = (_q(math.radians(v)) for v in (ALBERS_LAT1, ALBERS_LAT2, ALBERS_LAT0))
ALBERS_N = (_m1 * _m1 - _m2 * _m2) / (_q2 - _q1)
ALBERS_C = _m1 * _m1 + ALBERS_N * _q1
ALBERS_RHO0 = WGS84_A * math.sqrt(ALBERS_C - ALBERS_N * _q0) / ALBERS_N

Step = tuple[str, Callable]


def grid_shape(bounds=GRID_BOUNDS, resolution: float = GRID_RESOLUTION) -> tuple[int, int]:
    """(height, width) of the grid in cells."""
    xmin, ymin, xmax, ymax = bounds
    return int((ymax - ymin) / resolution), int((xmax - xmin) / resolution)


def albers_forward_steps(lat: str, lon: str, x: str, y: str, tmp: str) -> list[Step]:
    """Steps adding projected ``x``/``y`` metres from ``lat``/``lon`` degrees (G1)."""
    e, e2, n = WGS84_E, WGS84_E2, ALBERS_N
    return [
        (f"{tmp}s", lambda m, c: m.sin(m.radians(c(lat)))),
        (f"{tmp}q", lambda m, c: (c(f"{tmp}s") / (m.lit(1.0) - c(f"{tmp}s") * c(f"{tmp}s") * e2)
                                  - m.ln((m.lit(1.0) - c(f"{tmp}s") * e) / (m.lit(1.0) + c(f"{tmp}s") * e))
                                  * (1.0 / (2.0 * e))) * (1.0 - e2)),
        [(f"{tmp}rho", lambda m, c: m.sqrt(m.lit(ALBERS_C) - c(f"{tmp}q") * n) * (WGS84_A / n)),
         (f"{tmp}th", lambda m, c: (m.radians(c(lon)) - m.lit(math.radians(ALBERS_LON0))) * n)],
        [(x, lambda m, c: c(f"{tmp}rho") * m.sin(c(f"{tmp}th"))),
         (y, lambda m, c: m.lit(ALBERS_RHO0) - c(f"{tmp}rho") * m.cos(c(f"{tmp}th")))],
    ]


def albers_inverse_steps(x: str, y: str, lat: str, lon: str, tmp: str) -> list[Step]:
    """Steps adding ``lat``/``lon`` degrees from projected metres (G2), 5 fixed iterations."""
    e, e2, n = WGS84_E, WGS84_E2, ALBERS_N
    steps: list[Step] = [
        (f"{tmp}rho", lambda m, c: m.sqrt(c(x) * c(x) + (m.lit(ALBERS_RHO0) - c(y)) * (m.lit(ALBERS_RHO0) - c(y)))),
        (f"{tmp}q", lambda m, c: (m.lit(ALBERS_C) - (c(f"{tmp}rho") * (n / WGS84_A))
                                  * (c(f"{tmp}rho") * (n / WGS84_A))) / n),
        (f"{tmp}p0", lambda m, c: m.asin(c(f"{tmp}q") / 2.0)),
    ]
    for i in range(INVERSE_ITERATIONS):
        p, s = f"{tmp}p{i}", f"{tmp}s{i}"
        steps.append((s, lambda m, c, p=p: m.sin(c(p))))
        steps.append((f"{tmp}p{i + 1}", lambda m, c, p=p, s=s: c(p) + (
            (m.lit(1.0) - c(s) * c(s) * e2) * (m.lit(1.0) - c(s) * c(s) * e2) / (m.cos(c(p)) * 2.0)
            * (c(f"{tmp}q") / (1.0 - e2) - c(s) / (m.lit(1.0) - c(s) * c(s) * e2)
               + m.ln((m.lit(1.0) - c(s) * e) / (m.lit(1.0) + c(s) * e)) * (1.0 / (2.0 * e))))))
    last = f"{tmp}p{INVERSE_ITERATIONS}"
    steps.append((lat, lambda m, c: m.degrees(c(last))))
    steps.append((lon, lambda m, c: m.lit(ALBERS_LON0)
                  + m.degrees(m.atan2(c(x), m.lit(ALBERS_RHO0) - c(y)) / n)))
    return steps


def destination_steps(lat: str, lon: str, bearing_deg: float, dist_m: float,
                      lat_out: str, lon_out: str, tmp: str) -> list:
    """Steps adding the point ``dist_m`` metres from (lat, lon) on ``bearing_deg`` (G3, Vincenty direct).

    Independent quantities of one dependency level are grouped into one step.
    """
    f, a, b = WGS84_F, WGS84_A, WGS84_B
    sa1, ca1 = math.sin(math.radians(bearing_deg)), math.cos(math.radians(bearing_deg))
    t = tmp
    steps: list = [
        (f"{t}tu", lambda m, c: m.tan(m.radians(c(lat))) * (1.0 - f)),
        (f"{t}cu", lambda m, c: m.lit(1.0) / m.sqrt(c(f"{t}tu") * c(f"{t}tu") + 1.0)),
        [(f"{t}su", lambda m, c: c(f"{t}tu") * c(f"{t}cu")),
         (f"{t}s1", lambda m, c: m.atan2(c(f"{t}tu"), m.lit(ca1))),
         (f"{t}sa", lambda m, c: c(f"{t}cu") * sa1)],
        (f"{t}c2a", lambda m, c: m.lit(1.0) - c(f"{t}sa") * c(f"{t}sa")),
        [(f"{t}u2", lambda m, c: c(f"{t}c2a") * ((a * a - b * b) / (b * b))),
         (f"{t}cc", lambda m, c: c(f"{t}c2a") * (f / 16.0) * (m.lit(4.0) + (m.lit(4.0) - c(f"{t}c2a") * 3.0) * f))],
        [(f"{t}aa", lambda m, c: m.lit(1.0) + c(f"{t}u2") / 16384.0 * (
            m.lit(4096.0) + c(f"{t}u2") * (m.lit(-768.0) + c(f"{t}u2") * (m.lit(320.0) - c(f"{t}u2") * 175.0)))),
         (f"{t}bb", lambda m, c: c(f"{t}u2") / 1024.0 * (
             m.lit(256.0) + c(f"{t}u2") * (m.lit(-128.0) + c(f"{t}u2") * (m.lit(74.0) - c(f"{t}u2") * 47.0))))],
        (f"{t}sg0", lambda m, c: m.lit(dist_m) / (c(f"{t}aa") * b)),
    ]

    def sigma_terms(i: int) -> list:
        sg = f"{t}sg{i}"
        return [[
            (f"{t}cm{i}", lambda m, c: m.cos(c(f"{t}s1") * 2.0 + c(sg))),
            (f"{t}ss{i}", lambda m, c: m.sin(c(sg))),
            (f"{t}cs{i}", lambda m, c: m.cos(c(sg))),
        ]]

    for i in range(VINCENTY_ITERATIONS):
        steps += sigma_terms(i)
        cm, ss, cs = f"{t}cm{i}", f"{t}ss{i}", f"{t}cs{i}"
        steps.append((f"{t}sg{i + 1}", lambda m, c, cm=cm, ss=ss, cs=cs: m.lit(dist_m) / (c(f"{t}aa") * b)
                      + c(f"{t}bb") * c(ss) * (c(cm) + c(f"{t}bb") / 4.0 * (
                          c(cs) * (c(cm) * c(cm) * 2.0 - 1.0)
                          - c(f"{t}bb") / 6.0 * c(cm) * (c(ss) * c(ss) * 4.0 - 3.0) * (c(cm) * c(cm) * 4.0 - 3.0)))))
    k = VINCENTY_ITERATIONS
    steps += sigma_terms(k)
    sg, cm, ss, cs = f"{t}sg{k}", f"{t}cm{k}", f"{t}ss{k}", f"{t}cs{k}"
    steps += [
        [(f"{t}tmp", lambda m, c: c(f"{t}su") * c(ss) - c(f"{t}cu") * c(cs) * ca1),
         (f"{t}lam", lambda m, c: m.atan2(c(ss) * sa1, c(f"{t}cu") * c(cs) - c(f"{t}su") * c(ss) * ca1))],
        [(lat_out, lambda m, c: m.degrees(m.atan2(
            c(f"{t}su") * c(cs) + c(f"{t}cu") * c(ss) * ca1,
            m.sqrt(c(f"{t}sa") * c(f"{t}sa") + c(f"{t}tmp") * c(f"{t}tmp")) * (1.0 - f)))),
         (lon_out, lambda m, c: c(lon) + m.degrees(c(f"{t}lam") - (m.lit(1.0) - c(f"{t}cc")) * f * c(f"{t}sa") * (
             c(sg) + c(f"{t}cc") * c(ss) * (c(cm) + c(f"{t}cc") * c(cs) * (c(cm) * c(cm) * 2.0 - 1.0)))))],
    ]
    return steps


def pixel_steps(x: str, y: str, col_out: str, row_out: str, bounds=GRID_BOUNDS,
                resolution: float = GRID_RESOLUTION) -> list[Step]:
    """World metres to (col, row), truncated toward zero as ``int()`` does."""
    xmin, _, _, ymax = bounds
    return [[
        (col_out, lambda m, c: m.trunc_int((c(x) - xmin) / resolution)),
        (row_out, lambda m, c: m.trunc_int((m.lit(ymax) - c(y)) / resolution)),
    ]]


def zone_corner_steps(lat: str, lon: str, dist_m: float, k: int, bounds=GRID_BOUNDS,
                      resolution: float = GRID_RESOLUTION, bearings=CORNER_BEARINGS) -> list:
    """Corner ``k`` of the zone: destination on its bearing, projected, to pixel ``c{k}_x``/``c{k}_y``.

    A chain for each corner: all four at once are too much code for one method.
    """
    chain = destination_steps(lat, lon, bearings[k], dist_m, f"_z{k}lat", f"_z{k}lon", f"_z{k}v")
    chain += albers_forward_steps(f"_z{k}lat", f"_z{k}lon", f"_z{k}x", f"_z{k}y", f"_z{k}a")
    return chain + pixel_steps(f"_z{k}x", f"_z{k}y", f"c{k}_x", f"c{k}_y", bounds, resolution)
