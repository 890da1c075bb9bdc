"""SQL building blocks for the DuckDB cross-check queries.

These texts restate, in plain SQL, what the DataFrame operators compute, so an
independent engine can confirm the Spark results (``oracle_sql`` in
``__spark_entry__``). Numeric constants are written as ``CAST('<repr>' AS DOUBLE)``
so both engines use bit-identical doubles.
"""

from __future__ import annotations

import math

from sunset_engine.sources import testdata as TD


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def pm(x: str, n: float) -> str:
    """Positive remainder on doubles, as Spark's ``pmod``."""
    return f"((({x}) % {dbl(n)}) + {dbl(n)}) % {dbl(n)}"


def code(key: str) -> str:
    return f"'A' || lpad(cast({key} as varchar), 2, '0')"


def airports_cte() -> str:
    cases = " ".join(f"when n_regionkey = {k} then '{v}'" for k, v in TD.REGION_AIRPORT_TYPE.items())
    return f"""airports as (
  select {code('n_nationkey')} as airport_id,
         {dbl(27.3)} + (n_nationkey * 8) % 21 as latitude_deg,
         {dbl(-120.7)} + (n_nationkey * 11) % 50 as longitude_deg,
         case {cases} end as type
  from nation)"""


def sites_cte(name: str = "airports") -> str:
    cases = " ".join(f"when c_mktsegment = '{k}' then '{v}'" for k, v in TD.SEGMENT_AIRPORT_TYPE.items())
    return f"""{name} as (
  select 'C' || lpad(cast(c_custkey as varchar), 6, '0') as airport_id,
         {dbl(27.3)} + ((c_custkey * 37) % 2000) / {dbl(100.0)} as latitude_deg,
         {dbl(-120.7)} + ((c_custkey * 53) % 4900) / {dbl(100.0)} as longitude_deg,
         case {cases} end as type
  from customer)"""


def flights_cte() -> str:
    am = "((hour(ts) * 60 + minute(ts) + 90) % 1440)"
    return f"""flights as (
  select event_id, cast(ts as date) as flight_date,
         {code('user_id % 25')} as origin,
         {code('event_id % 25')} as dest,
         case when event_id % 40 = 0 then ''
              else cast(hour(ts) * 100 + minute(ts) as varchar) || '.0' end as dep_time,
         cast(({am} // 60) * 100 + {am} % 60 as varchar) || '.0' as arr_time
  from events where event_type <> 'error')"""


def strikes_cte() -> str:
    slot = "(user_id % 25)"
    return f"""strikes as (
  select event_id,
         lpad(cast(month(ts) as varchar), 2, '0') || '/' || lpad(cast(day(ts) as varchar), 2, '0')
           || '/' || cast(year(ts) as varchar) as incident_date,
         cast(month(ts) as integer) as incident_month,
         cast(year(ts) as integer) as incident_year,
         case when event_id % 47 = 0 then ' '
              else lpad(cast(hour(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0')
         end as time,
         'K' || {code(slot)} as airport_id,
         case when event_id % 50 = 0 then '' when event_id % 51 = 0 then 'n/a'
              else cast({dbl(27.3)} + ({slot} * 8) % 21 as varchar) end as airport_latitude,
         cast({dbl(-120.7)} + ({slot} * 11) % 50 as varchar) as airport_longitude
  from events where event_type = 'error')"""


def raster_cte() -> str:
    return f"""raster_cells as (
  select cast(l_orderkey % {TD.TEST_GRID_HEIGHT} as integer) as row,
         cast((l_partkey * 31 + l_suppkey * 17) % {TD.TEST_GRID_WIDTH} as integer) as col,
         sum(case when l_returnflag = 'R' then null else l_quantity end) as value
  from lineitem group by 1, 2)"""


def round_significant(x: str, digits: int = 10) -> str:
    scale = f"pow(10.0, floor(log10(abs({x}))) - {digits - 1})"
    return f"(case when ({x}) = 0 or ({x}) is null then ({x}) else round(({x}) / {scale}) * {scale} end)"


def hhmm_minutes(x: str) -> str:
    t = f"try_cast(trunc(try_cast(trim({x}) as double)) as integer)"
    return f"(({t}) // 100) * 60 + ({t}) % 100"


def clock_minutes(x: str) -> str:
    t = f"trim(replace({x}, '\"', ''))"
    return (f"case when strpos({t}, ':') > 0 then try_cast(split_part({t}, ':', 1) as integer) * 60"
            f" + try_cast(split_part({t}, ':', 2) as integer) end")


def to_double(x: str) -> str:
    return f"try_cast(trim(replace(cast({x} as varchar), '\"', '')) as double)"


def season_exclusive(d: str, start, end) -> str:
    md = f"(month({d}) * 100 + day({d}))"
    return f"{md} > {start[0] * 100 + start[1]} and {md} < {end[0] * 100 + end[1]}"


def solar_ctes(src: str, d: str, lat: str, lon: str, off: str, name: str = "solar") -> str:
    """CTE chain ``{name}`` = ``src`` plus ``sunset_minute``: the published algorithm with its numbers written out."""
    cos_zenith = math.cos(90.8333 * (math.pi / 180.0))
    steps = [
        ("_sun_lh", f"{lon} / {dbl(15.0)}"),
        ("_sun_t", f"dayofyear({d}) + ({dbl(18.0)} - _sun_lh) / {dbl(24.0)}"),
        ("_sun_m", f"_sun_t * {dbl(0.9856)} - {dbl(3.289)}"),
        ("_sun_l", pm(f"_sun_m + sin(radians(_sun_m)) * {dbl(1.916)}"
                      f" + sin(radians(_sun_m * {dbl(2.0)})) * {dbl(0.02)}"
                      f" + {dbl(282.634)}", 360.0)),
        ("_sun_ra0", pm(f"degrees(atan(tan(radians(_sun_l)) * {dbl(0.91764)}))", 360.0)),
        ("_sun_ra", f"(_sun_ra0 + floor(_sun_l / {dbl(90.0)}) * {dbl(90.0)}"
                    f" - floor(_sun_ra0 / {dbl(90.0)}) * {dbl(90.0)}) / {dbl(15.0)}"),
        ("_sun_sd", f"sin(radians(_sun_l)) * {dbl(0.39782)}"),
        ("_sun_cd", "cos(asin(_sun_sd))"),
        ("_sun_ch", f"case when _sun_cd * cos(radians({lat})) = 0 then null else"
                    f" ({dbl(cos_zenith)} - _sun_sd * sin(radians({lat}))) / (_sun_cd * cos(radians({lat}))) end"),
        ("_sun_ut", f"case when abs(_sun_ch) <= {dbl(1.0)} then "
                    + pm(f"degrees(acos(_sun_ch)) / {dbl(15.0)} + _sun_ra - _sun_t * {dbl(0.06571)}"
                         f" - {dbl(6.622)} - _sun_lh", 24.0) + " end"),
    ]
    parts = []
    prev = src
    for i, (col, expr) in enumerate(steps):
        cte = f"{name}_{i}"
        parts.append(f"{cte} as (select *, {expr} as {col} from {prev})")
        prev = cte
    local = pm(f"_sun_ut + {off}", 24.0)
    final = (f"{name} as (select * exclude (_sun_lh, _sun_t, _sun_m, _sun_l, _sun_ra0, _sun_ra, _sun_sd,"
             f" _sun_cd, _sun_ch, _sun_ut), cast({pm(f'round(({local}) * {dbl(60.0)})', 1440.0)} as integer)"
             f" as sunset_minute from {prev})")
    parts.append(final)
    return ",\n".join(parts)
