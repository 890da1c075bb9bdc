import datetime as dt

from pyspark.sql import functions as F

from sunset_engine.functions.solar import near_sunset, offset_from_timezone, with_sunset_minute
from sunset_engine.operators.season import season_exclusive, season_inclusive


def test_flight_season_ends_are_exclusive(spark):
    days = [dt.date(2019, 8, 1), dt.date(2019, 8, 2), dt.date(2019, 11, 29), dt.date(2019, 11, 30),
            dt.date(2020, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = [r.d for r in df.where(season_exclusive("d")).collect()]
    assert kept == [dt.date(2019, 8, 2), dt.date(2019, 11, 29)]
    # literal year bounds are added for scan pushdown and do not change the answer
    kept2 = [r.d for r in df.where(season_exclusive("d", years=(2018, 2020))).collect()]
    assert kept2 == kept


def test_strike_season_is_inclusive(spark):
    rows = [(2019, 7), (2019, 8), (2019, 11), (2019, 12), (2017, 9), (2018, 9), (2020, 9), (2021, 9)]
    df = spark.createDataFrame(rows, "y int, m int")
    kept = [(r.y, r.m) for r in df.where(season_inclusive("y", "m")).collect()]
    assert kept == [(2019, 8), (2019, 11), (2018, 9), (2020, 9)]


def _sunset(spark, rows, offset_col="off"):
    df = spark.createDataFrame(rows, "d date, lat double, lon double, off double")
    return [r.sunset_minute for r in with_sunset_minute(df, "d", "lat", "lon", offset_col).collect()]


def test_sunset_matches_published_times_within_a_minute(spark):
    # Denver 2019-10-01 (MDT, UTC-6): about 18:41; New York JFK 2019-11-15 (EST, UTC-5): about 16:38.
    got = _sunset(spark, [(dt.date(2019, 10, 1), 39.8617, -104.6731, -6.0),
                          (dt.date(2019, 11, 15), 40.6398, -73.7789, -5.0)])
    assert abs(got[0] - (18 * 60 + 41)) <= 1
    assert abs(got[1] - (16 * 60 + 38)) <= 1


def test_no_sunset_in_polar_night_is_null(spark):
    assert _sunset(spark, [(dt.date(2019, 12, 6), 71.3, -156.8, -9.0)]) == [None]


def test_timezone_offset_follows_dst(spark):
    df = spark.createDataFrame([(dt.date(2019, 7, 1), "America/Denver"), (dt.date(2019, 12, 1), "America/Denver"),
                                (dt.date(2019, 7, 1), "America/Phoenix"),
                                (dt.date(2019, 11, 3), "America/Denver"), (dt.date(2019, 11, 4), "America/Denver"),
                                (dt.date(2019, 3, 10), "America/New_York")], "d date, tz string")
    got = [r.o for r in df.select(offset_from_timezone("d", "tz").alias("o")).collect()]
    # a switch day has the offset of its noon, after the switch at 02:00
    assert got == [-6.0, -7.0, -7.0, -7.0, -7.0, -4.0]


def test_window_is_strict_and_does_not_wrap(spark):
    rows = [(600, 629), (600, 630), (600, 571), (600, 570), (1430, 10)]
    df = spark.createDataFrame(rows, "s int, m int")
    kept = [(r.s, r.m) for r in df.where(near_sunset("m", "s")).collect()]
    assert kept == [(600, 629), (600, 571)]
    assert df.where(near_sunset(F.col("m"), F.col("s"), 31)).count() == 4


# Named airports: code, latitude, longitude, zone.
NAMED = """DEN 39.86 -104.67 America/Denver; JFK 40.64 -73.78 America/New_York; PHX 33.43 -112.01 America/Phoenix; ORD 41.97 -87.90 America/Chicago
SFO 37.62 -122.38 America/Los_Angeles; ATL 33.64 -84.43 America/New_York; DFW 32.90 -97.04 America/Chicago; IAH 29.98 -95.34 America/Chicago
DTW 42.21 -83.35 America/Detroit; CVG 39.05 -84.66 America/New_York; IND 39.72 -86.29 America/Indiana/Indianapolis; CLE 41.41 -81.85 America/New_York
AUS 30.19 -97.67 America/Chicago; SAT 29.53 -98.47 America/Chicago; OKC 35.39 -97.60 America/Chicago; TPA 27.98 -82.53 America/New_York
ELP 31.81 -106.38 America/Denver; ABQ 35.04 -106.61 America/Denver; ANC 61.17 -150.00 America/Anchorage; HNL 21.32 -157.92 Pacific/Honolulu
SJU 18.44 -66.00 America/Puerto_Rico; SLC 40.79 -111.98 America/Denver; BNA 36.12 -86.68 America/Chicago; SDF 38.17 -85.74 America/Kentucky/Louisville
MIA 25.79 -80.29 America/New_York; SEA 47.45 -122.31 America/Los_Angeles; LAS 36.08 -115.15 America/Los_Angeles; BOI 43.56 -116.22 America/Boise
MSP 44.88 -93.22 America/Chicago; BHM 33.56 -86.75 America/Chicago; TYS 35.81 -83.99 America/New_York; TUS 32.12 -110.94 America/Phoenix
FAR 46.92 -96.82 America/Chicago; RAP 44.05 -103.06 America/Denver; GRR 42.88 -85.52 America/Detroit; PNS 30.47 -87.19 America/Chicago
TLH 30.40 -84.35 America/New_York; AMA 35.22 -101.71 America/Chicago; JNU 58.35 -134.58 America/Juneau; BIS 46.77 -100.75 America/Chicago"""


def test_zones_of_named_airports(spark):
    from sunset_engine.operators.timezones import nearest_timezone

    rows = [x.split() for x in NAMED.replace("\n", "; ").split("; ")]
    df = spark.createDataFrame([(c, float(la), float(lo)) for c, la, lo, _ in rows], "a string, lat double, lon double")
    got = {r.a: r.tz for r in df.select("a", nearest_timezone("lat", "lon").alias("tz")).collect()}
    assert len(rows) == 40 and got == {c: tz for c, _, _, tz in rows}


def test_a_table_of_zones_comes_first(spark):
    from sunset_engine.operators.timezones import with_timezones

    airports = spark.createDataFrame([("AAA", 39.86, -104.67), ("BBB", 39.86, -104.67)], "airport_id string, latitude_deg double, longitude_deg double")
    zones = spark.createDataFrame([("AAA", "America/New_York"), ("", "America/Chicago"), ("CCC", "")], "code string, timezone string")
    got = with_timezones(airports, zones)
    assert {r.airport_id: r.timezone for r in got.collect()} == {"AAA": "America/New_York", "BBB": None}
    from sunset_engine.operators import traffic as T

    sun = {r.airport_id: r.sunset_minute for r in T.calendar_solar_table(got, (9, 30), (10, 2), (2019, 2019)).collect()}
    assert sun["AAA"] == sun["BBB"] + 120 and abs(sun["BBB"] - (18 * 60 + 41)) <= 1


def test_sunsets_at_zone_time(spark):
    """Times worked out by hand from solar noon and day length; the last is the day the clocks change."""
    from sunset_engine.operators import traffic as T

    airports = spark.createDataFrame([("ATL", 33.64, -84.43), ("DFW", 32.90, -97.04), ("DTW", 42.21, -83.35), ("JFK", 40.64, -73.78)],
                                     "airport_id string, latitude_deg double, longitude_deg double")
    sun = {(r.airport_id, r.flight_date.isoformat()): r.sunset_minute for r in T.calendar_solar_table(airports, years=(2019, 2019)).collect()}
    for key, (h, m) in {("ATL", "2019-10-01"): (19, 22), ("DFW", "2019-10-01"): (19, 13), ("DTW", "2019-10-01"): (19, 15), ("JFK", "2019-11-03"): (16, 50)}.items():
        assert abs(sun[key] - (60 * h + m)) <= 2, (key, sun[key])


def test_fall_sunsets_get_earlier_every_day(spark):
    days = [dt.date(2019, 8, 2) + dt.timedelta(days=i) for i in range(120)]
    got = _sunset(spark, [(d, 39.86, -104.67, -7.0) for d in days])
    assert all(0 <= m < 1440 for m in got)
    assert all(b <= a for a, b in zip(got, got[1:]))
    assert got[0] - got[-1] > 150  # about three hours earlier by late November
