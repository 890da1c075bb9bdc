"""Official local sunset as Column math.

The sunset of a place and a day follows the closed-form solar algorithm of the
*Almanac for Computers* (1990, US Naval Observatory), with the official zenith of
90 degrees 50 minutes. It is written as a chain of steps, one projection per
dependency level, so Catalyst keeps each sub-expression once and the whole
chain runs inside one whole-stage-codegen span: no Python per row, no shuffle.

Where the day has no sunset (polar day or night) the result is NULL, and a
near-sunset filter then drops the row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col, pmod
from sunset_engine.functions.steps import apply_steps

# Fixed values of the published algorithm (not tuning knobs).
OFFICIAL_ZENITH_DEG = 90.8333
MEAN_ANOMALY_RATE = 0.9856
MEAN_ANOMALY_OFFSET = 3.289
CENTER_EQ_1 = 1.916
CENTER_EQ_2 = 0.020
PERIHELION_LONGITUDE = 282.634
RIGHT_ASCENSION_FACTOR = 0.91764
DECLINATION_SINE_FACTOR = 0.39782
SIDEREAL_RATE = 0.06571
SIDEREAL_OFFSET = 6.622

def offset_from_longitude(lon) -> Column:
    """Whole-hour UTC offset ``round(lon / 15)``: the solar time-zone approximation."""
    return F.round(as_col(lon) / 15.0)


def offset_from_timezone(date, tz) -> Column:
    """UTC offset in hours of an IANA zone in effect at local noon.

    On a DST switch day this is the offset after the switch (US zones switch at
    02:00), the one in effect at that evening's sunset. The arithmetic stays
    on ``timestamp_ntz`` wall clocks, so the session time zone does not enter;
    ``convert_timezone`` resolves the zone per row.
    """
    noon = F.make_timestamp_ntz(F.year(as_col(date)), F.month(as_col(date)), F.dayofmonth(as_col(date)),
                                F.lit(12), F.lit(0), F.lit(0))
    utc = F.convert_timezone(as_col(tz), F.lit("UTC"), noon)
    return F.timestamp_diff("SECOND", utc, noon) / 3600.0


def sunset_ut_steps(day_of_year, lat, lon, out: str = "_sun_ut") -> list:
    """Sunset in hours of universal time, less the longitude's own hours, NULL when the sun never sets or rises.

    Dependency-level steps (see ``steps.apply_steps``); temporaries start with ``_sun_``. The
    date enters by its day of the year alone.
    """
    cos_zenith = math.cos(math.radians(OFFICIAL_ZENITH_DEG))
    d, la, lo = as_col(day_of_year), as_col(lat), as_col(lon)
    return [
        ("_sun_lh", lambda m, c: lo / 15.0),
        ("_sun_t", lambda m, c: d + (F.lit(18.0) - c("_sun_lh")) / 24.0),
        ("_sun_m", lambda m, c: c("_sun_t") * MEAN_ANOMALY_RATE - MEAN_ANOMALY_OFFSET),
        ("_sun_l", lambda m, c: pmod(c("_sun_m") + F.sin(F.radians(c("_sun_m"))) * CENTER_EQ_1
                                     + F.sin(F.radians(c("_sun_m") * 2.0)) * CENTER_EQ_2 + PERIHELION_LONGITUDE,
                                     360.0)),
        [("_sun_ra0", lambda m, c: pmod(F.degrees(F.atan(F.tan(F.radians(c("_sun_l"))) * RIGHT_ASCENSION_FACTOR)),
                                        360.0)),
         ("_sun_sd", lambda m, c: F.sin(F.radians(c("_sun_l"))) * DECLINATION_SINE_FACTOR)],
        # right ascension moved into the quadrant of the true longitude, in hours
        [("_sun_ra", lambda m, c: (c("_sun_ra0") + F.floor(c("_sun_l") / 90.0) * 90.0
                                   - F.floor(c("_sun_ra0") / 90.0) * 90.0) / 15.0),
         ("_sun_cd", lambda m, c: F.cos(F.asin(c("_sun_sd"))))],
        ("_sun_ch", lambda m, c: F.try_divide(F.lit(cos_zenith) - c("_sun_sd") * F.sin(F.radians(la)),
                                              c("_sun_cd") * F.cos(F.radians(la)))),
        (out, lambda m, c: F.when(F.abs(c("_sun_ch")) <= 1.0,
                                  pmod(F.degrees(F.acos(c("_sun_ch"))) / 15.0 + c("_sun_ra")
                                       - c("_sun_t") * SIDEREAL_RATE - SIDEREAL_OFFSET - c("_sun_lh"), 24.0))),
    ]


def local_minute(ut, offset_hours) -> Column:
    """Minute of the local day (0-1439) of a universal time in hours."""
    return F.pmod(F.round(pmod(as_col(ut) + as_col(offset_hours), 24.0) * 60.0), F.lit(1440.0)).cast("int")


def with_sunset_minute(df: DataFrame, date, lat, lon, offset_hours, out: str = "sunset_minute") -> DataFrame:
    """Add ``out``: local sunset as minute of day (0-1439), NULL when the sun never sets/rises.

    ``date`` is a DATE column, ``lat``/``lon`` doubles in degrees (east positive),
    ``offset_hours`` the local UTC offset for that date.
    """
    steps = sunset_ut_steps(F.dayofyear(as_col(date)), lat, lon)
    return apply_steps(df, [*steps, (out, lambda m, c: local_minute(c("_sun_ut"), offset_hours))], "_sun_")


def near_sunset(minute, sunset_minute, half_window: int = 30) -> Column:
    """Event strictly within ``half_window`` minutes of sunset, no wrap at midnight."""
    return F.abs(as_col(minute) - as_col(sunset_minute)) < half_window
