"""DuckDB SQL for every catalog query that SQL can express (the correctness oracle).

Each text runs on the raw test tables (``nation``, ``events``, ``lineitem`` ...)
and rebuilds the bridging views itself. Formulas and constants are written out here, in
``sqltext`` and in ``geosql``; only the test data's parameters and the sunset algorithm's
published constants are shared with the Spark side.
Doubles that pass through transcendental math are rounded to 6 decimals in
both the query and its oracle.
"""

from __future__ import annotations

from sunset_engine.plans import geosql
from sunset_engine.plans import sqltext as Q
from sunset_engine.sources import testdata as TD

START, END = TD.TEST_FLIGHT_SEASON


def _tz_offset(date: str, tz: str) -> str:
    noon = f"(cast({date} as timestamp) + interval 12 hour)"
    return f"((epoch({noon}) - epoch(timezone({tz}, {noon}))) / {Q.dbl(3600.0)})"


def _near_flights_ctes(by_timezone: bool = False) -> str:
    season = Q.season_exclusive("flight_date", START, END)
    if by_timezone:
        offset = _tz_offset("t.flight_date", "z.timezone")
        tz_join = "join airport_tz z on z.airport_id = a.airport_id"
        tz_ctes = _airport_tz_ctes() + ",\n"
    else:
        offset = f"round(a.longitude_deg / {Q.dbl(15.0)})"
        tz_join = ""
        tz_ctes = ""
    return f"""with {Q.airports_cte()},
{tz_ctes}{Q.flights_cte()},
ends as (
  select event_id, flight_date, 'origin' as role, origin as airport_id, dep_time as time_text from flights
  where {season}
  union all
  select event_id, flight_date, 'dest' as role, dest as airport_id, arr_time as time_text from flights
  where {season}),
timed as (select *, {Q.hhmm_minutes('time_text')} as event_minute from ends),
joined as (
  select t.event_id, t.role, t.airport_id, a.latitude_deg, a.longitude_deg, t.flight_date, t.event_minute,
         {offset} as offset_hours
  from timed t join airports a on t.airport_id = a.airport_id {tz_join}
  where t.event_minute is not null),
{Q.solar_ctes('joined', 'flight_date', 'latitude_deg', 'longitude_deg', 'offset_hours')},
near as (
  select event_id, role, airport_id, latitude_deg, longitude_deg, flight_date, event_minute, sunset_minute
  from solar where event_minute > sunset_minute - 30 and event_minute < sunset_minute + 30),
freq as (
  select airport_id, latitude_deg, longitude_deg, count(*) as flight_count
  from near group by airport_id, latitude_deg, longitude_deg)"""


def _near_strikes_ctes(by_timezone: bool = False) -> str:
    offset = f"round(longitude_deg / {Q.dbl(15.0)})"
    zones = ""
    if by_timezone:
        near = _haversine("p.latitude_deg", "p.longitude_deg", "z.la", "z.lo")
        zones = f"""{_tz_points()},
zoned as (select event_id, arg_min(z.tz, struct_pack(d := {near}, tz := z.tz)) as timezone from parsed p join tz_points z on true
          where p.latitude_deg is not null and p.longitude_deg is not null group by event_id),
"""
        offset = _tz_offset("incident_date", "(select timezone from zoned where zoned.event_id = parsed.event_id)")
    y0, y1 = TD.TEST_STRIKE_YEARS
    m0, m1 = TD.TEST_STRIKE_MONTHS
    return f"""{Q.strikes_cte()},
parsed as (
  select event_id, trim(replace(airport_id, '"', '')) as airport_id,
         try_strptime(trim(incident_date), '%m/%d/%Y')::date as incident_date,
         {Q.clock_minutes('time')} as event_minute,
         {Q.to_double('airport_latitude')} as latitude_deg,
         {Q.to_double('airport_longitude')} as longitude_deg
  from strikes
  where incident_year between {y0} and {y1} and incident_month between {m0} and {m1}),
{zones}typed as (
  select *, {offset} as offset_hours from parsed
  where event_minute is not null and latitude_deg is not null and longitude_deg is not null
    and incident_date is not null),
{Q.solar_ctes('typed', 'incident_date', 'latitude_deg', 'longitude_deg', 'offset_hours', name='ssolar')},
near_strikes as (
  select event_id, airport_id, latitude_deg, longitude_deg, incident_date, event_minute, sunset_minute
  from ssolar where event_minute > sunset_minute - 30 and event_minute < sunset_minute + 30),
strike_counts as (
  select airport_id, latitude_deg, longitude_deg, count(*) as strike_count
  from near_strikes group by airport_id, latitude_deg, longitude_deg)"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    dp = f"({p2} - {p1})"
    dl = f"(radians({lon2}) - radians({lon1}))"
    h = f"pow(sin({dp} / 2), 2) + cos({p1}) * cos({p2}) * pow(sin({dl} / 2), 2)"
    return f"asin(least({Q.dbl(1.0)}, sqrt({h}))) * 2"


# The oracle's own copy of the reference points: zone, then latitude and longitude of each.
TZ_POINTS = """
America/New_York: 40.7 -74.0, 42.4 -71.0, 43.6 -70.3, 44.8 -68.8, 44.5 -73.2, 42.9 -78.7, 40.5 -80.2, 38.9 -77.0,
36.9 -76.2, 35.9 -78.8, 35.2 -80.9, 32.9 -80.0, 33.6 -84.4, 32.1 -81.2, 30.5 -81.7, 25.8 -80.3, 28.0 -82.5,
30.4 -84.35, 28.4 -81.3, 26.5 -81.8, 35.8 -84.0, 35.0 -85.2, 38.0 -84.6, 39.05 -84.7, 40.0 -82.9, 41.4 -81.8,
38.4 -81.6, 37.3 -80.0, 32.5 -84.9
America/Detroit: 42.2 -83.35, 42.9 -85.5, 44.7 -85.6, 46.5 -84.4, 46.35 -87.4
America/Indiana/Indianapolis: 39.7 -86.3, 41.0 -85.2, 41.7 -86.3
America/Kentucky/Louisville: 38.2 -85.7
America/Chicago: 41.9 -87.8, 42.95 -87.9, 44.5 -88.1, 44.9 -93.2, 46.8 -92.2, 46.9 -96.8, 46.8 -100.75,
48.3 -101.3, 47.95 -97.2, 43.6 -96.7, 44.4 -100.3, 41.3 -95.9, 41.1 -100.7, 41.5 -93.7, 38.7 -90.4, 39.3 -94.7,
37.2 -93.4, 37.65 -97.4, 37.9 -100.7, 35.4 -97.6, 36.2 -95.9, 35.2 -101.7, 33.7 -101.8, 31.9 -102.2, 32.4 -99.7,
32.9 -97.0, 30.2 -97.7, 29.5 -98.5, 30.0 -95.3, 27.8 -97.5, 25.9 -97.4, 27.5 -99.5, 29.4 -100.9, 30.9 -102.9,
34.7 -92.2, 35.0 -90.0, 36.1 -86.7, 37.1 -88.8, 38.0 -87.5, 36.96 -86.4, 33.6 -86.75, 34.6 -86.8, 32.3 -86.4,
31.3 -85.45, 30.7 -88.2, 30.5 -87.2, 30.4 -85.8, 30.0 -90.3, 32.4 -93.8, 32.3 -90.1
America/Denver: 39.9 -104.7, 38.8 -104.7, 39.1 -108.5, 37.2 -107.8, 35.0 -106.6, 31.8 -106.4, 33.3 -104.5,
40.8 -112.0, 37.0 -113.5, 41.2 -104.8, 42.9 -106.5, 45.8 -108.5, 47.5 -111.4, 46.9 -114.1, 48.2 -106.6,
46.4 -105.9, 44.0 -103.1, 41.9 -103.6, 46.8 -102.8, 39.4 -101.7, 32.7 -103.2, 48.3 -114.3
America/Boise: 43.6 -116.2, 42.5 -114.5, 43.5 -112.1
America/Phoenix: 33.4 -112.0, 32.1 -110.9, 35.1 -111.7, 32.7 -114.6, 36.9 -111.4
America/Los_Angeles: 33.9 -118.4, 32.7 -117.2, 33.8 -116.5, 36.1 -115.2, 39.5 -119.8, 40.8 -115.8, 37.6 -122.4,
36.8 -119.7, 41.0 -124.1, 42.4 -122.9, 45.6 -122.6, 44.25 -121.15, 47.4 -122.3, 47.6 -117.5, 46.4 -117.0,
46.3 -119.1, 39.3 -114.8
America/Anchorage: 61.2 -150.0, 64.8 -147.9, 60.8 -161.8, 71.3 -156.8, 57.75 -152.5
America/Juneau: 58.35 -134.6, 55.4 -131.7
America/Nome: 64.5 -165.4
America/Adak: 51.9 -176.6
Pacific/Honolulu: 21.3 -157.9, 19.7 -155.0, 22.0 -159.3
America/Puerto_Rico: 18.4 -66.0
America/St_Thomas: 18.3 -65.0
Pacific/Guam: 13.5 144.8, 15.1 145.7
Pacific/Pago_Pago: -14.3 -170.7
"""


def _tz_points() -> str:
    rows, zone = [], ""
    for word in TZ_POINTS.replace(",", " ").split():
        if word.endswith(":"):
            zone = word[:-1]
        else:
            rows.append((zone, word))
    pairs = zip(rows[::2], rows[1::2], strict=True)
    values = ", ".join(f"('{tz}', {Q.dbl(float(la))}, {Q.dbl(float(lo))})" for (tz, la), (_, lo) in pairs)
    return f"tz_points as (select * from (values {values}) as t(tz, la, lo))"


def _airport_tz_ctes() -> str:
    return f"""{_tz_points()},
airport_tz as (
  select airport_id, tz as timezone from (
    select a.airport_id, p.tz,
           row_number() over (partition by a.airport_id, a.latitude_deg, a.longitude_deg
                              order by {_haversine('a.latitude_deg', 'a.longitude_deg', 'p.la', 'p.lo')}, p.tz) as rn
    from airports a join tz_points p on true) where rn = 1)"""


def _known_codes_cte() -> str:
    return """known as (select distinct airport_id as code from airports
  where type in ('medium_airport', 'large_airport') and airport_id <> '')"""


# Grid of the test raster: 290 rows and 461 columns of 10 km; zones reach 50 miles to a corner.
GRID_ROWS, GRID_COLS, CELL, ZONE_METRES = 290, 461, 10000.0, 50 * 1609.344


def _geo_ctes(sites: bool = False) -> str:
    corner_cols = ", ".join(f"c{k}_{v}" for k in range(4) for v in ("x", "y"))
    source = Q.sites_cte() if sites else Q.airports_cte()
    col, row = geosql.pixel("x", "y", CELL)
    return f"""{source},
{geosql.constants()},
geo_src as (select airport_id, latitude_deg, longitude_deg from airports
  where latitude_deg is not null and longitude_deg is not null),
{geosql.albers('geo_src', 'latitude_deg', 'longitude_deg', 'proj0')},
proj as (select * from proj0 where isfinite(x) and isfinite(y)),
{geosql.albers_inverse('proj', 'rtrip')},
{geosql.corners('proj', 'corn', ZONE_METRES, CELL)},
pix as (select *, {col} as col, {row} as row from corn),
zones as (select airport_id, latitude_deg, longitude_deg, col, row, {corner_cols} from pix
  where row >= 0 and row < {GRID_ROWS} and col >= 0 and col < {GRID_COLS})"""


def _side(xa: str, ya: str, xb: str, yb: str) -> str:
    return f"case when ({xb} - {xa}) * (row - {ya}) - ({yb} - {ya}) * (col - {xa}) >= 0 then 1 else -1 end"


def _raster_ctes() -> str:
    h, w = GRID_ROWS, GRID_COLS
    v0 = "coalesce(case when isnan(value) then 0.0 else value end, 0.0)"
    s = [_side("c2_x", "c2_y", "c3_x", "c3_y"), _side("c3_x", "c3_y", "c0_x", "c0_y"),
         _side("c0_x", "c0_y", "c1_x", "c1_y"), _side("c1_x", "c1_y", "c2_x", "c2_y")]
    return f"""{Q.raster_cte()},
rstats as (
  select case when count(*) < {h * w} then least(min({v0}), 0.0) else min({v0}) end as mn,
         case when count(*) < {h * w} then greatest(max({v0}), 0.0) else max({v0}) end as mx
  from raster_cells where row >= 0 and row < {h} and col >= 0 and col < {w}),
norm as (
  select row, col, case when mx <> mn then ({v0} - mn) / (mx - mn) else {v0} end as value
  from raster_cells, rstats where row >= 0 and row < {h} and col >= 0 and col < {w}),
zero_norm as (select case when mx <> mn then (0.0 - mn) / (mx - mn) else 0.0 end as z from rstats),
bbox as (
  select z.*, unnest(generate_series(least(c0_y, c1_y, c2_y, c3_y), greatest(c0_y, c1_y, c2_y, c3_y))) as row_
  from zones z),
bbox2 as (
  select * exclude (row, col, row_), row_ as row,
         unnest(generate_series(least(c0_x, c1_x, c2_x, c3_x), greatest(c0_x, c1_x, c2_x, c3_x))) as col
  from bbox),
zone_pix as (
  select airport_id, latitude_deg, longitude_deg, cast(row as integer) as row, cast(col as integer) as col
  from bbox2
  where {s[0]} = {s[1]} and {s[1]} = {s[2]} and {s[2]} = {s[3]}
    and row >= 0 and row < {h} and col >= 0 and col < {w}),
zonal as (
  select p.airport_id,
         avg(coalesce(n.value, (select z from zero_norm))) as bird_population,
         count(*) as n_pixels
  from zone_pix p left join norm n on p.row = n.row and p.col = n.col
  group by p.airport_id, p.latitude_deg, p.longitude_deg)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    geo = "with " + _geo_ctes(sites=True)
    q["albers_forward"] = geo + "\nselect airport_id, round(x, 3) as x, round(y, 3) as y from proj"
    q["albers_round_trip"] = geo + """
select airport_id, round(lat_back, 9) as lat_back, round(lon_back, 9) as lon_back from rtrip"""
    corner_cols = ", ".join(f"c{k}_{v}" for k in range(4) for v in ("x", "y"))
    q["zone_corners"] = geo + f"\nselect airport_id, col, row, {corner_cols} from zones"
    q["zone_outline"] = geo + "\n" + """select airport_id, point, x, y from (
  select airport_id, 0 as point, c0_x as x, c0_y as y from zones
  union all select airport_id, 1, c1_x, c1_y from zones
  union all select airport_id, 2, c2_x, c2_y from zones
  union all select airport_id, 3, c3_x, c3_y from zones
  union all select airport_id, 4, c0_x, c0_y from zones)"""
    q["zone_labels"] = geo + """
select airport_id, cast(col as double) - 1.0 as label_x, cast(row as double) - 7.0 as label_y from zones"""
    q["presence_raster"] = geo + "\nselect distinct row, col, cast(1.0 as float) as value from zones"
    q["zone_pixels"] = geo + ",\n" + _raster_ctes() + "\nselect airport_id, row, col from zone_pix"
    raster = "with " + _geo_ctes() + ",\n" + _raster_ctes()
    q["normalized_raster"] = raster + "\nselect row, col, round(value, 6) as value from norm"
    q["nonzero_cells"] = ("with " + Q.raster_cte() + """
select row, col from raster_cells where coalesce(case when isnan(value) then 0.0 else value end, 0.0) <> 0""")
    q["zonal_mean"] = raster + """
select airport_id, round(bird_population, 6) as bird_population, n_pixels from zonal"""
    q["season_filter_exclusive"] = f"""select o_orderkey, cast(o_orderdate as date) as order_date from orders
where {Q.season_exclusive('cast(o_orderdate as date)', (8, 1), (11, 30))}"""
    q["season_filter_inclusive"] = """select o_orderkey, cast(year(o_orderdate) as integer) as order_year,
       cast(month(o_orderdate) as integer) as order_month from orders
where year(o_orderdate) between 1996 and 1998 and month(o_orderdate) between 8 and 11"""
    cut = "substring(trim(dep_time), 1, length(trim(dep_time)) - 2)"
    q["hhmm_to_minutes"] = f"""with {Q.flights_cte()}
select event_id, {Q.hhmm_minutes('dep_time')} as dep_minute,
       (try_cast({cut} as integer) // 100) * 60 + try_cast({cut} as integer) % 100 as dep_minute_compat,
       {Q.hhmm_minutes('arr_time')} as arr_minute
from flights"""
    q["parse_strike_times"] = f"""with {Q.strikes_cte()}
select event_id, try_strptime(trim(incident_date), '%m/%d/%Y')::date as incident_date,
       {Q.clock_minutes('time')} as event_minute
from strikes where trim(replace(time, '"', '')) <> ''"""
    t_min = Q.clock_minutes('time')
    bad_coord = f"({Q.to_double('airport_latitude')} is null or {Q.to_double('airport_longitude')} is null)"
    bad_day = "try_strptime(trim(incident_date), '%m/%d/%Y') is null"
    q["strike_rejects"] = f"""with {Q.strikes_cte()}
select count(*) as n_rows,
       cast(count_if(({t_min}) is null) as bigint) as n_bad_time,
       cast(count_if({bad_coord}) as bigint) as n_bad_coordinates,
       cast(count_if({bad_day}) as bigint) as n_bad_date,
       cast(count_if(({t_min}) is not null and not {bad_coord} and not ({bad_day})) as bigint) as n_kept
from strikes"""
    q["clean_coordinates"] = f"""with {Q.strikes_cte()}
select * from (
  select event_id, {Q.to_double('airport_latitude')} as latitude_deg,
         {Q.to_double('airport_longitude')} as longitude_deg from strikes)
where event_id is not null and latitude_deg is not null and longitude_deg is not null"""
    q["airport_keys"] = f"""with {Q.sites_cte()}
select trim(replace(airport_id, '"', '')) as airport_id, latitude_deg, longitude_deg, type from airports
where trim(replace(airport_id, '"', '')) <> '' and type in ('medium_airport', 'large_airport')"""
    q["text_fields"] = """select s_suppkey, line, split_part(line, ',', 1) as first_field,
       reverse(split_part(reverse(line), ',', 1)) as last_field,
       split_part(line, ',', 2) as second_field,
       substr(s_name, 2) as name_tail,
       cast(s_suppkey as varchar) || ': ' || s_name as key_line
from (select s_suppkey, s_name,
             cast(s_suppkey as varchar) || ',' || s_name || ',' || cast(s_nationkey as varchar) as line
      from supplier)"""
    q["first_rows"] = "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 10"
    lines = "(select l_suppkey, count(*) as line_count from lineitem group by l_suppkey)"
    q["top_n"] = f"select * from {lines} order by line_count desc, l_suppkey limit 50"
    q["bottom_n"] = f"select * from {lines} order by line_count asc, l_suppkey limit 50"
    q["top_and_bottom"] = f"""(select *, 'top' as list from {lines} order by line_count desc, l_suppkey limit 50)
union all
(select *, 'bottom' as list from {lines} order by line_count asc, l_suppkey limit 50)"""
    q["missing_codes"] = f"""with {Q.airports_cte()}, {Q.flights_cte()}, {_known_codes_cte()}
select distinct code from (select origin as code from flights union all select dest as code from flights)
where code not in (select code from known)"""
    q["missing_timezones"] = f"""with {Q.airports_cte()}, {_known_codes_cte()}
select distinct {Q.code('c_nationkey')} as code from customer
where {Q.code('c_nationkey')} not in (select code from known)"""
    q["nearest_timezone"] = f"""with {Q.sites_cte()}, {_airport_tz_ctes()}
select airport_id, timezone from airport_tz"""
    xy = "(select l_orderkey, l_linenumber, l_quantity as x, l_extendedprice as y from lineitem)"
    q["pearson"] = f"select count(*) as n, round(corr(x, y), 6) as pearson_r from {xy}"
    q["line_fit"] = f"""select round(regr_slope(y, x), 6) as slope, round(regr_intercept(y, x), 6) as intercept,
       round(regr_r2(y, x), 6) as r2 from {xy}"""
    fitted = f"""fitted as (
  select l_orderkey, l_linenumber, x as l_quantity, y as l_extendedprice,
         x * (select regr_slope(y, x) from {xy}) + (select regr_intercept(y, x) from {xy}) as fitted
  from {xy})"""
    q["fit_residuals"] = f"""with {fitted}
select l_orderkey, l_linenumber, round(l_quantity, 6) as l_quantity, round(l_extendedprice, 6) as l_extendedprice,
       round(fitted, 6) as fitted, round(l_extendedprice - fitted, 6) as residual from fitted"""
    e = "(l_extendedprice - fitted)"
    sig = Q.round_significant
    q["regression_metrics"] = f"""with {fitted}
select {sig(f"sqrt(avg({e} * {e}))")} as rmse, {sig(f"avg({e} * {e})")} as mse,
       {sig(f"avg(abs({e}))")} as mae,
       {sig(f"1 - sum({e} * {e}) / (var_pop(l_extendedprice) * count(*))")} as r2
from fitted"""
    # Two-sided p-value of r: Student t tail through the regularised incomplete
    # beta function, evaluated by the same continued fraction as a recursive CTE.
    q["pearson_p_value"] = f"""with recursive
st as (select count(*) as n, cast(count(*) as double) as nd,
              covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) as r
       from {xy} where x is not null and y is not null),
prm as (select n, r, (nd - 2) / 2 as a0, cast(0.5 as double) as b0,
               (nd - 2) / ((nd - 2) + r * r * (nd - 2) / (1 - r * r)) as x0 from st),
sw as (select n, r, x0 > (a0 + 1.0) / (a0 + b0 + 2.0) as flip,
              case when x0 > (a0 + 1.0) / (a0 + b0 + 2.0) then b0 else a0 end as a,
              case when x0 > (a0 + 1.0) / (a0 + b0 + 2.0) then a0 else b0 end as b,
              case when x0 > (a0 + 1.0) / (a0 + b0 + 2.0) then 1.0 - x0 else x0 end as x from prm),
fr as (select *, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1.0 - x)) / a as front,
              1.0 - (a + b) * x / (a + 1.0) as d0 from sw),
cf(m, c, d, h) as (
  select 0, cast(1 as double), 1 / d0, 1 / d0 from fr
  union all
  select m + 1, c2, d2, h * d1 * c1 * d2 * c2 from (
    select m, h, d1, c1, 1.0 / (1.0 + n2 * d1) as d2, 1.0 + n2 / c1 as c2 from (
      select m, h, n2, 1.0 / (1.0 + n1 * d) as d1, 1.0 + n1 / c as c1 from (
        select cf.m, cf.c, cf.d, cf.h,
               (cf.m + 1) * (b - (cf.m + 1)) * x / ((a + 2 * (cf.m + 1) - 1) * (a + 2 * (cf.m + 1))) as n1,
               -(a + (cf.m + 1)) * (a + b + (cf.m + 1)) * x / ((a + 2 * (cf.m + 1)) * (a + 2 * (cf.m + 1) + 1)) as n2
        from cf, fr where cf.m < 3000))))
select n, round(r, 9) as pearson_r,
       round(case when abs(r) >= 1 then 0.0 when flip then 1.0 - front * h else front * h end, 9) as p_value
from fr, (select h from cf where m = 3000)"""
    q["dataset_profile"] = """select count(*) as n_rows, cast(count_if(event_id is null) as bigint) as nulls_event_id,
       cast(count_if(ts is null) as bigint) as nulls_ts, cast(count_if(user_id is null) as bigint) as nulls_user_id,
       cast(count_if(event_type is null) as bigint) as nulls_event_type, cast(count_if(value is null) as bigint) as nulls_value,
       cast(count_if(props is null) as bigint) as nulls_props from events"""
    near = _near_flights_ctes()

    q["near_sunset_flights"] = near + "\nselect * from near"
    q["near_sunset_flights_tz"] = _near_flights_ctes(by_timezone=True) + "\nselect * from near"
    q["flight_frequencies"] = near + "\nselect * from freq"
    q["top_airports"] = near + """
select * from freq order by flight_count desc, airport_id, latitude_deg, longitude_deg limit 50"""

    q["bottom_airports"] = near + """
select * from freq order by flight_count asc, airport_id, latitude_deg, longitude_deg limit 50"""
    q["top_and_bottom_airports"] = near + """,
top as (select *, 'top' as list from freq order by flight_count desc, airport_id, latitude_deg, longitude_deg limit 50),
bottom as (select *, 'bottom' as list from freq
           order by flight_count asc, airport_id, latitude_deg, longitude_deg limit 50)
select * from top union all select * from bottom"""
    q["solar_table"] = f"""with {Q.airports_cte()},
{Q.flights_cte()},
keys as (
  select distinct airport_id, flight_date from (
    select origin as airport_id, flight_date from flights where {Q.season_exclusive('flight_date', START, END)}
    union all
    select dest as airport_id, flight_date from flights where {Q.season_exclusive('flight_date', START, END)})),
joined as (
  select k.airport_id, a.latitude_deg, a.longitude_deg, k.flight_date,
         round(a.longitude_deg / {Q.dbl(15.0)}) as offset_hours
  from keys k join airports a on k.airport_id = a.airport_id),
{Q.solar_ctes('joined', 'flight_date', 'latitude_deg', 'longitude_deg', 'offset_hours')}
select airport_id, latitude_deg, longitude_deg, flight_date, sunset_minute from solar"""

    (m0, d0), (m1, d1) = START, END
    y0, y1 = TD.TEST_FLIGHT_YEARS
    q["solar_calendar"] = f"""with {Q.sites_cte()},
days as (select flight_date from (select unnest(generate_series(date '{y0}-01-01', date '{y1}-12-31', interval 1 day))::date as flight_date)
  where month(flight_date) * 100 + day(flight_date) > {m0 * 100 + d0} and month(flight_date) * 100 + day(flight_date) < {m1 * 100 + d1}),
joined as (
  select a.airport_id, a.latitude_deg, a.longitude_deg, d.flight_date,
         round(a.longitude_deg / {Q.dbl(15.0)}) as offset_hours
  from airports a join days d on true where a.airport_id <> ''),
{Q.solar_ctes('joined', 'flight_date', 'latitude_deg', 'longitude_deg', 'offset_hours')}
select airport_id, latitude_deg, longitude_deg, flight_date, sunset_minute from solar"""
    q["solar_calendar_fall"] = f"""with {Q.sites_cte()}, {_airport_tz_ctes()},
days as (select unnest(generate_series(date '2019-08-02', date '2019-11-29', interval 1 day))::date as flight_date),
joined as (
  select a.airport_id, a.latitude_deg, a.longitude_deg, d.flight_date, {_tz_offset('d.flight_date', 'z.timezone')} as offset_hours
  from airports a join airport_tz z on z.airport_id = a.airport_id join days d on true where a.airport_id <> ''),
{Q.solar_ctes('joined', 'flight_date', 'latitude_deg', 'longitude_deg', 'offset_hours')}
select airport_id, latitude_deg, longitude_deg, flight_date, sunset_minute from solar"""
    q["iso_dates"] = """select o_orderkey, case when regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast(t as date) end as order_date
from (select o_orderkey, case when o_orderkey % 7 = 0 then strftime(o_orderdate, '%m/%d/%Y') when o_orderkey % 11 = 0 then ''
        else strftime(o_orderdate, '%Y-%m-%d') end as t from orders)"""
    strikes = _near_strikes_ctes()
    q["strike_counts"] = "with " + strikes + "\nselect * from strike_counts"
    q["near_sunset_strikes"] = "with " + strikes + "\nselect * from near_strikes"
    both = near + ",\n" + strikes
    q["strike_per_flight"] = both + """
select f.airport_id, f.latitude_deg, f.longitude_deg,
       cast(s.strike_count as double) as strike_count, cast(f.flight_count as double) as flight_count,
       cast(s.strike_count as double) / cast(f.flight_count as double) as strike_ratio
from freq f join (select substr(airport_id, 2) as airport_id, strike_count from strike_counts) s
  on f.airport_id = s.airport_id"""
    q["training_table"] = both + ",\n" + _geo_ctes().replace(Q.airports_cte() + ",", "", 1) + ",\n" + _raster_ctes() + """
select z.airport_id, round(z.bird_population, 6) as bird_population,
       cast(s.strike_count as double) as bird_strike_count, cast(f.flight_count as double) as flight_count,
       round(cast(s.strike_count as double) / cast(f.flight_count as double), 6) as bird_flight_ratio
from zonal z
join freq f on f.airport_id = z.airport_id
join (select substr(airport_id, 2) as airport_id, strike_count from strike_counts) s on f.airport_id = s.airport_id"""
    q["training_stats"] = q["training_table"].split("\nselect z.airport_id")[0] + """,
training as (
  select z.bird_population, cast(s.strike_count as double) / cast(f.flight_count as double) as ratio
  from zonal z join freq f on f.airport_id = z.airport_id
  join (select substr(airport_id, 2) as airport_id, strike_count from strike_counts) s
    on f.airport_id = s.airport_id)
select count(*) as n, round(corr(bird_population, ratio), 6) as pearson_r,
       round(regr_slope(ratio, bird_population), 6) as slope,
       round(regr_intercept(ratio, bird_population), 6) as intercept,
       round(regr_r2(ratio, bird_population), 6) as r2
from training"""
    q["flight_csv"] = f"with {Q.flights_cte()} select flight_date, origin, dest, dep_time, arr_time from flights"
    q["flight_csv_headers"] = q["flight_csv"]
    q["cells_round_trip"] = f"with {Q.raster_cte()} select row, col, value, cast(row // 256 as integer) as tile_row from raster_cells"
    q["code_list_csv"] = "select distinct 'N' || cast(c_nationkey as varchar) as code from customer"
    q["csv_columns"] = """select c_custkey, case when c_custkey % 17 <> 0 and c_custkey % 13 <> 0 then c_custkey end as key,
  case when c_custkey % 17 <> 0 then c_name || ', Inc.' end as name, case when c_custkey % 17 <> 0 then 'the "' || c_mktsegment || '" one' end as segment,
  case when c_custkey % 17 <> 0 then (c_custkey % 100) / 4.0::double end as share from customer"""
    q["inferred_types"] = """select * from (values
  (0, 'p_partkey', 'int', (select count(*) from part)), (1, 'name', 'string', (select count(*) from part)), (2, 'quarter', 'double', (select count(*) from part)),
  (3, 'even', 'boolean', (select count(*) from part where p_partkey % 3 = 0)), (4, 'day', 'date', (select count(*) from part)), (5, 'nothing', 'double', 0)) as t(position, name, type, n_values)"""
    q["near_sunset_strikes_tz"] = "with " + _near_strikes_ctes(by_timezone=True) + "\nselect * from near_strikes"
    q["timezone_by_place"] = q["nearest_timezone"]
    q["nearest_depot"] = f"""with {Q.sites_cte()},
depots as (select s_name, {Q.dbl(27.3037)} + ((s_suppkey * 71) % 2000) / {Q.dbl(100.0)} as lat, {Q.dbl(-120.6929)} + ((s_suppkey * 97) % 4900) / {Q.dbl(100.0)} as lon from supplier)
select airport_id, arg_min(s_name, struct_pack(d := {_haversine('latitude_deg', 'longitude_deg', 'lat', 'lon')}, n := s_name)) as s_name
from airports join depots on true group by airport_id"""
    q["forest_walk"] = """select l_orderkey, l_linenumber, round((select avg(case when l_quantity <= 5 + k * 2 then case when l_extendedprice <= 10000 + k * 1000 then k else k * 2 + 1 end
  else case when l_extendedprice <= 70000 - k * 1000 then k * 3 + 2 else k * 5 - 7 end end) from (select n_nationkey as k from nation)), 6) as prediction
from lineitem"""
    copies = """select l_returnflag as f, l_linestatus as s, cast(l_quantity as integer) as q,
  row_number() over (partition by l_returnflag, l_linestatus, cast(l_quantity as integer)) as copy from lineitem"""
    row = """'42:{"l_returnflag":"' || f || '","l_linestatus":"' || s || '","quantity":"' || q || '"}:' || copy"""
    q["row_split"] = f"""select f as l_returnflag, s as l_linestatus, q as quantity,
  case when ('0x' || substr(md5({row}), 1, 7))::bigint % 1000 < 700 then 'train' else 'test' end as part, count(*) as n from ({copies}) group by 1, 2, 3, 4"""
    split = "('0x' || substr(md5('42:' || airport_id), 1, 7))::bigint % 1000"
    rows = q["training_table"]
    q["rf_split"] = f"select airport_id, case when {split} < 700 then 'train' else 'test' end as part from ({rows})"
    q["rf_folds"] = f"""select airport_id, cast(('0x' || substr(md5('fold:42:' || airport_id), 1, 7))::bigint % 5 as integer) as fold from ({rows}) where {split} < 700"""
    q["rf_test_rows"] = f"""select airport_id, bird_population, flight_count, bird_flight_ratio from ({rows}) where {split} >= 700"""
    q["strike_ratio_left"] = both + """
select f.airport_id, f.latitude_deg, f.longitude_deg, f.flight_count, s.strike_count,
       cast(coalesce(s.strike_count, 0) as double) / cast(f.flight_count as double) as strike_ratio
from freq f left join (select substr(airport_id, 2) as airport_id, strike_count from strike_counts) s
  on f.airport_id = s.airport_id"""
    q["ratio_report_file"] = q["strike_ratio_left"]
    return q
