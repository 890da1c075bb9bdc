"""Near-sunset flights and strikes, counts per airport, ratios and top/bottom lists.

Plan shape for the flight side (the large table):

    scan flights once (pruned to 5 columns; season range pushed down; month
                       folders pruned on the year/month-partitioned table)
      -> explode origin/destination roles      (narrow, one pass instead of two scans)
      -> parse hhmm, drop invalid              (narrow)
      -> hash join with one row per airport: an array of sunset times by day of the year,
         looked up by index                    (broadcast behind a check of the airport count)
      -> the +-30 min test
      -> partial count per airport             (map-side combine)
      -> shuffle of at most #airports rows per task -> final count

The trigonometry runs once per airport and day of the season, not per flight, and nothing
of the flights has to be known before: no pre-scan of their dates, and years play no part,
since the algorithm depends on the day of the year and the zone's offset on the row's date.

A hub holding a third of all flights costs nothing extra: the flight side is
never shuffled before the map-side partial aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunset_engine.functions.columns import safe_ratio, to_double
from sunset_engine.functions.solar import (local_minute, near_sunset, offset_from_longitude, offset_from_timezone,
                                           sunset_ut_steps, with_sunset_minute)
from sunset_engine.functions.steps import step_value
from sunset_engine.functions.text import drop_first_char, strip_quotes
from sunset_engine.functions.timeparse import clock_to_minutes, hhmm_to_minutes, parse_us_date
from sunset_engine.operators.joins import broadcast_if_bounded, spread
from sunset_engine.operators.season import (FALL_END, FALL_MONTHS, FALL_START, FALL_YEARS, season_exclusive,
                                            season_inclusive)
from sunset_engine.operators.timezones import nearest_timezone

GROUP_KEY = ["airport_id", "latitude_deg", "longitude_deg"]

# Sunsets (8 bytes each, one per airport and season day) that may be broadcast: within 100 MB.
SOLAR_BROADCAST_VALUES = 12_000_000


def airport_keys(airports: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Airports keyed by code: quotes stripped, empty codes dropped, coordinates as doubles.

    Duplicated codes are kept (each copy joins), as the reference does. ``types``
    keeps only the listed airport types (F12), e.g. medium and large airports.
    """
    cols = [strip_quotes("airport_id").alias("airport_id"),
            to_double("latitude_deg").alias("latitude_deg"),
            to_double("longitude_deg").alias("longitude_deg")]
    extra = [c for c in ("type", "timezone") if c in airports.columns]
    out = airports.select(*cols, *extra).where(F.col("airport_id") != "")
    if types is not None:
        out = out.where(F.col("type").isin(list(types)))
    return out


def flight_roles(flights: DataFrame) -> DataFrame:
    """One row per flight end: departure at the origin, arrival at the destination.

    A bag: a flight whose both ends qualify counts at both airports.
    """
    ends = F.array(
        F.struct(F.lit("origin").alias("role"), F.col("origin").alias("airport_id"),
                 F.col("dep_time").alias("time_text")),
        F.struct(F.lit("dest").alias("role"), F.col("dest").alias("airport_id"),
                 F.col("arr_time").alias("time_text")),
    )
    return flights.select("event_id", "flight_date", F.inline(ends))


def _zoned(places: DataFrame, offset: str) -> DataFrame:
    """With ``zone``, the zone of every place: its ``timezone``, or else the nearest reference point's; NULL for offsets by longitude.

    The search of the nearest point is the dear part, so places get it before their rows are multiplied by days.
    """
    if offset not in ("longitude", "timezone"):
        raise ValueError(f"offset must be 'longitude' or 'timezone', not {offset!r}")
    zone = F.lit(None).cast("string")
    if offset == "timezone":
        zone = nearest_timezone("latitude_deg", "longitude_deg")
        zone = F.coalesce(F.col("timezone"), zone) if "timezone" in places.columns else zone
    return places.withColumn("zone", zone)


def _offset(zoned: DataFrame, date: str, offset: str) -> DataFrame:
    hours = offset_from_longitude("longitude_deg") if offset == "longitude" else offset_from_timezone(date, "zone")
    return zoned.withColumn("offset_hours", hours)


def _season(flights: DataFrame, start, end, years) -> DataFrame:
    """Season filter; on a table partitioned by ``flight_year``/``flight_month`` it also
    prunes partitions (the month range and, when known, the year range)."""
    out = flights.where(season_exclusive("flight_date", start, end, years))
    if "flight_month" in flights.columns:
        out = out.where(F.col("flight_month").between(start[0], end[0]))
    if years is not None and "flight_year" in flights.columns:
        out = out.where(F.col("flight_year").between(years[0], years[1]))
    return out


def _season_ends(flights: DataFrame, start, end, years, compat: bool) -> DataFrame:
    season = _season(flights, start, end, years)
    ends = flight_roles(season)
    return (ends.select("event_id", "flight_date", "role", "airport_id",
                        hhmm_to_minutes("time_text", compat).alias("event_minute"))
            .where(F.col("event_minute").isNotNull() & (F.col("airport_id") != "")))


def season_days(start, end, years: tuple[int, int]) -> list[tuple[dt.date, dt.date]]:
    """First and last kept day of the exclusive season in each year (empty years skipped)."""
    out = []
    first, last = start[0] * 100 + start[1], end[0] * 100 + end[1]
    for y in range(years[0], years[1] + 1):
        days = [d for n in range(366) if (d := dt.date(y, 1, 1) + dt.timedelta(days=n)).year == y
                and first < d.month * 100 + d.day < last]
        if days:
            out.append((days[0], days[-1]))
    return out


def _solar(joined: DataFrame, offset: str) -> DataFrame:
    joined = with_sunset_minute(_offset(joined, "flight_date", offset), "flight_date",
                                "latitude_deg", "longitude_deg", "offset_hours")
    return joined.select(*GROUP_KEY, "flight_date", "sunset_minute")


def solar_table(flights: DataFrame, airports: DataFrame, start=FALL_START, end=FALL_END,
                years: tuple[int, int] | None = None, offset: str = "timezone",
                compat: bool = False) -> DataFrame:
    """Sunset minute for every (airport, date) that a season flight end touches.

    The keys are a distinct over the flights' origin, destination and date
    (map-side partial aggregate, so the shuffle carries at most #airports x #days
    rows per task), joined to the size-checked airport dimension. Each airport
    copy keeps its own coordinates, so duplicated codes fan out as in the reference.
    """
    # Keys need no time-validity filter (extra keys only add unused solar rows), so
    # this scan reads three flight columns: origin, destination and date.
    season = _season(flights, start, end, years)
    keys = (season.select("flight_date", F.explode(F.array("origin", "dest")).alias("airport_id"))
            .where(F.col("airport_id") != "").distinct())
    return _solar(keys.join(broadcast_if_bounded(_zoned(airport_keys(airports), offset)), "airport_id"), offset)


def calendar_solar_table(airports: DataFrame, start=FALL_START, end=FALL_END, years=FALL_YEARS,
                         offset: str = "timezone") -> DataFrame:
    """Sunset minute for every airport on every day of the season (E1), without reading flights.

    Each airport row gets its zone and then expands to its season days with ``explode(sequence(...))``:
    #airports x #days rows, a size known before anything runs.
    """
    days = season_days(start, end, years)
    ranges = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in days])
    if not days:                               # a season without a day
        ranges = F.array().cast("array<struct<lo:date,hi:date>>")
    ap = _zoned(spread(airport_keys(airports)), offset)
    days = (ap.select(*GROUP_KEY, "zone", F.explode(ranges).alias("r"))
            .select(*GROUP_KEY, "zone", F.explode(F.sequence("r.lo", "r.hi")).alias("flight_date")))
    return _solar(days, offset)


def season_day_range(start, end) -> tuple[int, int]:
    """First and last day of the year that the exclusive season can touch, leap years or not; (1, 0) when none."""
    days = [d.timetuple().tm_yday for lo_hi in season_days(start, end, (2019, 2020)) for d in lo_hi]
    return (min(days), max(days)) if days else (1, 0)


def airport_sunsets(airports: DataFrame, start=FALL_START, end=FALL_END, offset: str = "timezone") -> DataFrame:
    """One row per airport: its zone, and the universal time of sunset on every day of the season.

    Columns: the group key, ``zone`` (NULL for offsets by longitude), ``first_day`` and
    ``sunsets`` (index 0 is that day of the year), ``copies`` (rows of this airport).
    """
    lo, hi = season_day_range(start, end)
    each = _zoned(airport_keys(airports), offset).groupBy(*GROUP_KEY, "zone").agg(F.count(F.lit(1)).alias("copies"))
    if lo > hi:                                # a season without a day: no airport has a sunset
        return each.where("false").select("*", F.lit(lo).alias("first_day"), F.array().cast("array<double>").alias("sunsets"))
    # One projection: the formula is bound within the array, so airports are neither multiplied by days nor grouped again.
    sunset = F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda day: step_value(sunset_ut_steps(day, "latitude_deg", "longitude_deg", "ut"), "ut"))
    return each.select(*GROUP_KEY, "zone", "copies", F.lit(lo).alias("first_day"), sunset.alias("sunsets"))


def near_sunset_flights(flights: DataFrame, airports: DataFrame, start=FALL_START, end=FALL_END,
                        years: tuple[int, int] | None = None, offset: str = "timezone",
                        half_window: int = 30, compat: bool = False,
                        max_airports: int | None = None) -> DataFrame:
    """Flight ends within +-``half_window`` minutes of local sunset at their airport.

    Every flight end meets its airport's row (``airport_sunsets``) in one hash join and
    looks its day up by index. ``max_airports`` bounds the broadcast of those rows, by default so that all their sunsets
    are ``SOLAR_BROADCAST_VALUES`` at most; with more, the same join is planned by shuffle. ``years`` only narrows the flights read.
    """
    ends = _season_ends(flights, start, end, years, compat)
    if max_airports is None:
        first, last = season_day_range(start, end)
        max_airports = SOLAR_BROADCAST_VALUES // max(1, last - first + 1)
    sunsets = broadcast_if_bounded(airport_sunsets(airports, start, end, offset), max_airports)
    hours = offset_from_longitude("longitude_deg") if offset == "longitude" else offset_from_timezone("flight_date", "zone")
    ut = F.get("sunsets", F.dayofyear("flight_date") - F.col("first_day"))
    near = (ends.join(sunsets, "airport_id").withColumn("sunset_minute", local_minute(ut, hours))
            .where(near_sunset("event_minute", "sunset_minute", half_window)))
    return (near.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("event_id", "role", "airport_id", "latitude_deg", "longitude_deg", "flight_date",
                    "event_minute", "sunset_minute"))


def flight_frequencies(near_flights: DataFrame) -> DataFrame:
    """Near-sunset flight ends per (airport, latitude, longitude) (A1)."""
    return near_flights.groupBy(*GROUP_KEY).agg(F.count(F.lit(1)).alias("flight_count"))


def parse_strikes(strikes: DataFrame) -> DataFrame:
    """Typed strike rows: date, minute of day and coordinates; unusable rows dropped."""
    extra = ["timezone"] if "timezone" in strikes.columns else []
    return (strikes
            .select("event_id", *extra,
                    strip_quotes("airport_id").alias("airport_id"),
                    parse_us_date("incident_date").alias("incident_date"),
                    F.col("incident_year"), F.col("incident_month"),
                    clock_to_minutes("time").alias("event_minute"),
                    to_double("airport_latitude").alias("latitude_deg"),
                    to_double("airport_longitude").alias("longitude_deg"))
            .where(F.col("event_minute").isNotNull() & F.col("latitude_deg").isNotNull()
                   & F.col("longitude_deg").isNotNull() & F.col("incident_date").isNotNull()))


def strike_rejects(strikes: DataFrame) -> DataFrame:
    """One row: strike rows read, rejected per reason, and kept by ``parse_strikes``.

    Where the reference would stop on a bad value, rows with unusable fields are
    dropped; this report counts them, in one aggregate pass.
    """
    minute = clock_to_minutes("time")
    lat, lon = to_double("airport_latitude"), to_double("airport_longitude")
    day = parse_us_date("incident_date")
    bad_coord = lat.isNull() | lon.isNull()
    return strikes.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(minute.isNull()).alias("n_bad_time"),
        F.count_if(bad_coord).alias("n_bad_coordinates"),
        F.count_if(day.isNull()).alias("n_bad_date"),
        F.count_if(minute.isNotNull() & ~bad_coord & day.isNotNull()).alias("n_kept"),
    )


def near_sunset_strikes(strikes: DataFrame, years=FALL_YEARS, months=FALL_MONTHS,
                        offset: str = "timezone", half_window: int = 30) -> DataFrame:
    """Strikes in the season and within +-``half_window`` minutes of sunset at the strike's position.

    The sunset is computed per strike: one pass over the strikes, no shuffle. Zones come
    from a ``timezone`` column, or without one from the strike's position, by an expression over the reference points.
    """
    s = parse_strikes(strikes.where(season_inclusive("incident_year", "incident_month", years, months)))
    s = with_sunset_minute(_offset(_zoned(s, offset), "incident_date", offset), "incident_date", "latitude_deg", "longitude_deg", "offset_hours")
    # The window test stays above the formula: pushed below, it would repeat the formula's text at every level.
    return (s.withColumn("sunset_minute", F.explode(F.array("sunset_minute")))
            .where(near_sunset("event_minute", "sunset_minute", half_window))
            .select("event_id", "airport_id", "latitude_deg", "longitude_deg", "incident_date",
                    "event_minute", "sunset_minute"))


def strike_counts(near_strikes: DataFrame) -> DataFrame:
    """Near-sunset strikes per (airport, latitude, longitude) (A2)."""
    return near_strikes.groupBy(*GROUP_KEY).agg(F.count(F.lit(1)).alias("strike_count"))


def strike_per_flight(frequencies: DataFrame, counts: DataFrame) -> DataFrame:
    """Inner join on the 3-letter code and strikes per flight.

    Strike counts keyed by (id, lat, lon) join on the id alone, so an id with two
    strike coordinates yields two rows, as in the reference.
    """
    s = counts.select(drop_first_char("airport_id").alias("airport_id"), "strike_count")
    return (frequencies.join(s, "airport_id")
            .select(*GROUP_KEY,
                    F.col("strike_count").cast("double").alias("strike_count"),
                    F.col("flight_count").cast("double").alias("flight_count"),
                    safe_ratio("strike_count", "flight_count").alias("strike_ratio")))


def strike_ratio_left(frequencies: DataFrame, counts: DataFrame) -> DataFrame:
    """Every airport with flights, strikes 0 when none, sorted by ratio."""
    s = counts.select(drop_first_char("airport_id").alias("airport_id"), "strike_count")
    return (frequencies.join(s, "airport_id", "left")
            .select(*GROUP_KEY, "flight_count", "strike_count",
                    safe_ratio(F.coalesce(F.col("strike_count"), F.lit(0)), "flight_count")
                    .alias("strike_ratio"))
            .orderBy(F.asc_nulls_last("strike_ratio"), *GROUP_KEY))


def top_n(df: DataFrame, count_col: str, keys: list[str], n: int = 50, ascending: bool = False) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) count; ties broken by the key.

    Planned as ``TakeOrderedAndProject``: every task keeps its own top ``n``, so
    no full sort or range shuffle of the input happens.
    """
    order = F.asc(count_col) if ascending else F.desc(count_col)
    return df.orderBy(order, *[F.asc(k) for k in keys]).limit(n)


def top_and_bottom(df: DataFrame, count_col: str, keys: list[str], n: int = 50) -> DataFrame:
    """Top ``n`` followed by bottom ``n``; a bag, so overlaps appear twice."""
    return (top_n(df, count_col, keys, n).withColumn("list", F.lit("top"))
            .unionByName(top_n(df, count_col, keys, n, ascending=True).withColumn("list", F.lit("bottom"))))
