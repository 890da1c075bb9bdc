"""Hand-written DuckDB SQL for the projection, the zone corners and the pixels (the oracle's own formulas).

Nothing here comes from ``functions.geo``: constants and formulas are written out again from the
published sources (Snyder 1987 for the Albers conic on the ellipsoid, Vincenty 1975 for the
direct problem), so that a wrong term on either side shows.
"""

from __future__ import annotations

# WGS84, the grid's projection and bounds (metres).
CONSTANTS = """geo_a as (select 6378137.0::double as a, (1 / 298.257223563)::double as f, radians(29.5) as p1, radians(45.5) as p2,
         radians(23.0) as p0, radians(-96.0) as l0, 3172000.0::double as top, -2356000.0::double as leftmost),
geo_b as (select *, a * (1 - f) as b, f * (2 - f) as e2, sqrt(f * (2 - f)) as e from geo_a),
geo_c as (select *, cos(p1) / sqrt(1 - e2 * sin(p1) ** 2) as m1, cos(p2) / sqrt(1 - e2 * sin(p2) ** 2) as m2,
         {q1} as q1, {q2} as q2, {q0} as q0 from geo_b),
geo_d as (select *, (m1 * m1 - m2 * m2) / (q2 - q1) as n from geo_c),
geo_k as (select *, m1 * m1 + n * q1 as c, a * sqrt(m1 * m1 + n * q1 - n * q0) / n as rho0 from geo_d)"""


def _q(s: str) -> str:
    return f"(1 - e2) * (({s}) / (1 - e2 * ({s}) * ({s})) - ln((1 - e * ({s})) / (1 + e * ({s}))) / (2 * e))"


def constants() -> str:
    return CONSTANTS.format(q1=_q("sin(p1)"), q2=_q("sin(p2)"), q0=_q("sin(p0)"))


def albers(source: str, lat: str, lon: str, name: str, x: str = "x", y: str = "y") -> str:
    """CTEs ending in ``name``: ``source`` with projected x and y."""
    return f"""{name}_q as (select s.*, {_q(f"sin(radians({lat}))")} as _q, k.* exclude (a, f, b), k.a as _a from {source} s, geo_k k),
{name} as (select * exclude (_q, _a, p1, p2, p0, l0, top, leftmost, e2, e, m1, m2, q1, q2, q0, n, c, rho0),
         _a * sqrt(c - n * _q) / n * sin(n * (radians({lon}) - l0)) as {x},
         rho0 - _a * sqrt(c - n * _q) / n * cos(n * (radians({lon}) - l0)) as {y} from {name}_q)"""


def albers_inverse(source: str, name: str, rounds: int = 6) -> str:
    """CTEs ending in ``name``: ``source`` (x, y) with lat_back and lon_back."""
    parts = [f"""{name}_0 as (select s.*, k.e2 as e2, k.e as e, k.n as n, k.rho0 as rho0, k.l0 as l0,
         (k.c - (s.x * s.x + (k.rho0 - s.y) * (k.rho0 - s.y)) * k.n * k.n / (k.a * k.a)) / k.n as qq from {source} s, geo_k k)""",
             f"{name}_1 as (select *, asin(qq / 2) as phi from {name}_0)"]
    for i in range(1, rounds):
        parts.append(f"""{name}_{i + 1} as (select * replace (phi + (1 - e2 * sin(phi) * sin(phi)) ** 2 / (2 * cos(phi))
           * (qq / (1 - e2) - sin(phi) / (1 - e2 * sin(phi) * sin(phi)) + ln((1 - e * sin(phi)) / (1 + e * sin(phi))) / (2 * e)) as phi) from {name}_{i})""")
    parts.append(f"""{name} as (select * exclude (e2, e, n, rho0, l0, qq, phi), degrees(phi) as lat_back,
         degrees(l0 + atan2(x, rho0 - y) / n) as lon_back from {name}_{rounds})""")
    return ",\n".join(parts)


def corners(source: str, name: str, metres: float, cell: float, rounds: int = 6) -> str:
    """CTEs ending in ``name``: ``source`` (latitude_deg, longitude_deg, a key) with pixels c0_x .. c3_y of the points
    ``metres`` away on bearings 45, 135, 225 and 315 degrees; one row for each airport row."""
    p = f"{name}_v"
    parts = [
        f"{name}_src as (select *, row_number() over () as _id from {source})",
        f"""{p}0 as (select s._id, s.latitude_deg, s.longitude_deg, t.corner, radians(45.0 + 90.0 * t.corner) as az, k.a as a, k.b as b, k.f as f,
         atan((1 - k.f) * tan(radians(s.latitude_deg))) as u1 from {name}_src s, geo_k k, (select unnest([0, 1, 2, 3]) as corner) t)""",
        f"{p}1 as (select *, atan2(tan(u1), cos(az)) as sigma1, cos(u1) * sin(az) as sinalpha from {p}0)",
        f"{p}2 as (select *, 1 - sinalpha * sinalpha as cos2alpha from {p}1)",
        f"{p}3 as (select *, cos2alpha * (a * a - b * b) / (b * b) as usq from {p}2)",
        f"""{p}4 as (select *, 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))) as biga,
         usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) as bigb from {p}3)""",
        f"{p}5_0 as (select *, {metres!r}::double / (b * biga) as sigma from {p}4)",
    ]
    for i in range(rounds):
        parts.append(f"{p}6_{i} as (select *, cos(2 * sigma1 + sigma) as c2m from {p}5_{i})")
        parts.append(f"""{p}5_{i + 1} as (select * exclude (c2m) replace ({metres!r}::double / (b * biga) + bigb * sin(sigma) * (c2m + bigb / 4 * (
           cos(sigma) * (-1 + 2 * c2m * c2m) - bigb / 6 * c2m * (-3 + 4 * sin(sigma) ** 2) * (-3 + 4 * c2m * c2m))) as sigma) from {p}6_{i})""")
    parts += [
        f"""{p}7 as (select *, cos(2 * sigma1 + sigma) as c2m, f / 16 * cos2alpha * (4 + f * (4 - 3 * cos2alpha)) as bigc,
         atan2(sin(sigma) * sin(az), cos(u1) * cos(sigma) - sin(u1) * sin(sigma) * cos(az)) as lam from {p}5_{rounds})""",
        f"""{p}8 as (select _id, corner,
         degrees(atan2(sin(u1) * cos(sigma) + cos(u1) * sin(sigma) * cos(az),
           (1 - f) * sqrt(sinalpha * sinalpha + (sin(u1) * sin(sigma) - cos(u1) * cos(sigma) * cos(az)) ** 2))) as lat2,
         longitude_deg + degrees(lam - (1 - bigc) * f * sinalpha * (sigma + bigc * sin(sigma) * (c2m + bigc * cos(sigma) * (-1 + 2 * c2m * c2m)))) as lon2
         from {p}7)""",
        albers(f"{p}8", "lat2", "lon2", f"{p}9", "x2", "y2"),
        f"""{p}10 as (select _id, {', '.join(f"max(case when corner = {k} then {pixel('x2', 'y2', cell)[i]} end) as c{k}_{v}" for k in range(4) for i, v in enumerate('xy'))}
         from {p}9 group by _id)""",
        f"{name} as (select s.* exclude (_id), v.* exclude (_id) from {name}_src s join {p}10 v on s._id = v._id)",
    ]
    return ",\n".join(parts)


def pixel(x: str, y: str, cell: float) -> tuple[str, str]:
    """(column, row) of a point, truncated toward zero."""
    return f"cast(trunc(({x} - (-2356000.0)) / {cell!r}) as integer)", f"cast(trunc((3172000.0 - {y}) / {cell!r}) as integer)"
