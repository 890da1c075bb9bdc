import datetime as dt
import re

from sunset_engine.operators import traffic as T

FLIGHTS = "event_id long, flight_date date, origin string, dest string, dep_time string, arr_time string"
AIRPORTS = "airport_id string, latitude_deg string, longitude_deg string, type string"

# Denver on 2019-10-01, daylight saving time: sunset 18:41 (1121).
DAY = dt.date(2019, 10, 1)


def _airports(spark):
    return spark.createDataFrame([
        ('"DEN"', "39.8617", "-104.6731", "large_airport"),
        ("DEN", "39.8617", "-104.6731", "large_airport"),      # duplicated code: both copies join
        ("APA", "39.5701", "-104.8490", "medium_airport"),
        ('""', "40.0", "-100.0", "small_airport"),             # empty code: dropped
    ], AIRPORTS)


def _sunset(spark):
    a = T.airport_keys(_airports(spark)).where("airport_id = 'APA'").limit(1)
    s = T.solar_table(spark.createDataFrame([(1, DAY, "APA", "APA", "1.0", "1.0")], FLIGHTS), a)
    return s.collect()[0].sunset_minute


def test_both_ends_and_duplicates(spark):
    s = _sunset(spark)
    hhmm = lambda m: f"{m // 60 * 100 + m % 60}.0"
    flights = spark.createDataFrame([
        (1, DAY, "DEN", "APA", hhmm(s), hhmm(s + 10)),     # both ends near sunset: two rows (+1 for dup DEN)
        (2, DAY, "APA", "DEN", hhmm(s + 29), hhmm(s + 30)),  # 29 min kept, 30 min dropped
        (3, DAY, "APA", "XXX", "", hhmm(s)),              # blank departure, unknown destination
        (4, dt.date(2019, 8, 1), "APA", "APA", hhmm(s), hhmm(s)),  # season start excluded
    ], FLIGHTS)
    near = T.near_sunset_flights(flights, _airports(spark))
    got = sorted((r.event_id, r.role, r.airport_id) for r in near.collect())
    assert got == [(1, "dest", "APA"), (1, "origin", "DEN"), (1, "origin", "DEN"), (2, "origin", "APA")]
    freq = {r.airport_id: r.flight_count for r in T.flight_frequencies(near).collect()}
    assert freq == {"APA": 2, "DEN": 2}


def test_strike_ratios_and_code_strip(spark):
    freq = spark.createDataFrame([("DEN", 39.8, -104.6, 10), ("ANC", 61.1, -150.0, 4), ("ZZZ", 1.0, 1.0, 0)],
                                 "airport_id string, latitude_deg double, longitude_deg double, flight_count long")
    counts = spark.createDataFrame([("KDEN", 39.8, -104.6, 5), ("PANC", 61.1, -150.0, 1), ("KDEN", 39.9, -104.6, 1),
                                    ("K", 0.0, 0.0, 3), ("KZZZ", 1.0, 1.0, 2)],
                                   "airport_id string, latitude_deg double, longitude_deg double, strike_count long")
    inner = sorted((r.airport_id, r.strike_count, r.strike_ratio) for r in T.strike_per_flight(freq, counts).collect())
    # KDEN has two strike coordinates: two rows (fan-out kept); zero flights give NULL, not an error
    assert inner == [("ANC", 1.0, 0.25), ("DEN", 1.0, 0.1), ("DEN", 5.0, 0.5), ("ZZZ", 2.0, None)]
    noflights = spark.createDataFrame([("LAX", 0.0, 0.0, 8)], freq.schema)
    left = {r.airport_id: r.strike_ratio for r in T.strike_ratio_left(freq.unionByName(noflights), counts).collect()}
    assert left["LAX"] == 0.0 and left["ZZZ"] is None


def test_top_and_bottom_ties_and_overlap(spark):
    df = spark.createDataFrame([("B", 1.0, 1.0, 5), ("A", 2.0, 2.0, 5), ("A", 1.0, 1.0, 5), ("C", 0.0, 0.0, 1)],
                               "airport_id string, latitude_deg double, longitude_deg double, flight_count long")
    top = [(r.airport_id, r.latitude_deg) for r in T.top_n(df, "flight_count", T.GROUP_KEY, 2).collect()]
    assert top == [("A", 1.0), ("A", 2.0)]
    both = T.top_and_bottom(df, "flight_count", T.GROUP_KEY, 3).collect()
    assert len(both) == 6  # fewer than 2N groups: overlaps appear twice
    plan = T.top_n(df, "flight_count", T.GROUP_KEY, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_flight_plan_broadcasts_and_prunes(spark, tmp_dir):
    path = f"{tmp_dir}/flights"
    s = _sunset(spark)
    spark.createDataFrame([(i, DAY, "APA", "DEN", f"{s // 60 * 100 + s % 60}.0", "0.0") for i in range(50)],
                          FLIGHTS).write.parquet(path)
    near = T.near_sunset_flights(spark.read.parquet(path), _airports(spark), years=(2019, 2019))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(flight_date,2019-01-01)" in pushed and "LessThanOrEqual(flight_date," in pushed
    assert "BatchEvalPython" not in plan
    assert plan.count("FileScan parquet [event_id") == 1, plan             # flights are scanned once
    assert near.count() == 50
    every_year = T.near_sunset_flights(spark.read.parquet(path), _airports(spark))
    assert every_year._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [event_id") == 1
    assert sorted(r.event_id for r in every_year.collect()) == sorted(r.event_id for r in near.collect())
    # above the bound on airports the same join is not hinted: same rows
    unhinted = T.near_sunset_flights(spark.read.parquet(path), _airports(spark), max_airports=0)
    assert sorted(r.event_id for r in unhinted.collect()) == sorted(r.event_id for r in near.collect())


def test_every_year_is_kept(spark):
    s = _sunset(spark)
    hhmm = f"{s // 60 * 100 + s % 60}.0"
    flights = spark.createDataFrame([(y, dt.date(y, 10, 1), "APA", "ZZZ", hhmm, "") for y in (1999, 2016, 2019, 2021, 2024)], FLIGHTS)
    assert sorted(r.event_id for r in T.near_sunset_flights(flights, _airports(spark)).collect()) == [1999, 2016, 2019, 2021, 2024]
    assert [r.event_id for r in T.near_sunset_flights(flights, _airports(spark), years=(2018, 2020)).collect()] == [2019]


def test_seasons_without_a_day_or_with_odd_ends(spark):
    flights = spark.createDataFrame([(1, DAY, "APA", "APA", "1841.0", "1841.0")], FLIGHTS)
    for start, end in (((8, 1), (8, 2)), ((11, 1), (2, 1)), ((8, 1), (8, 1))):
        assert T.near_sunset_flights(flights, _airports(spark), start, end).collect() == []
        assert T.calendar_solar_table(_airports(spark), start, end, (2019, 2020)).collect() == []
    days = [r.flight_date for r in T.calendar_solar_table(_airports(spark), (2, 27), (2, 30), (2019, 2020)).where("airport_id = 'APA'").collect()]
    assert sorted(days) == [dt.date(2019, 2, 28), dt.date(2020, 2, 28), dt.date(2020, 2, 29)]
    assert T.near_sunset_flights(flights, _airports(spark), (2, 29), (12, 31), (2019, 2019)).count() > 0


def test_lookup_agrees_with_the_calendar_table(spark):
    """The array looked up by day gives the sunset of the airport-day table, over a clock change and two years."""
    days = [dt.date(y, 11, d) for y in (2019, 2020) for d in (1, 2, 3, 4, 28)]
    flights = spark.createDataFrame([(i, d, "APA", "ZZZ", "1200.0", "") for i, d in enumerate(days)], FLIGHTS)
    for offset in ("timezone", "longitude"):
        table = {r.flight_date: r.sunset_minute for r in T.calendar_solar_table(_airports(spark), years=(2019, 2020), offset=offset)
                 .where("airport_id = 'APA'").collect()}
        near = T.near_sunset_flights(flights, _airports(spark), offset=offset, half_window=2000).collect()
        assert {r.flight_date: r.sunset_minute for r in near} == {d: table[d] for d in days}


def test_code_check_is_a_hash_anti_join(spark):
    from sunset_engine.operators import quality as QL

    f = spark.createDataFrame([(1, DAY, "DEN", "ATL", "1.0", "1.0"), (2, DAY, "XXX", "DEN", "1.0", "1.0")], FLIGHTS)
    known = spark.createDataFrame([("DEN",), ("ATL",)], "code string")
    missing = QL.missing_codes(QL.flight_codes(f), known)
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastNestedLoopJoin" not in plan
    assert [r.code for r in missing.collect()] == ["XXX"]


def test_zones_are_searched_once_an_airport_not_once_a_day(spark):
    table = T.calendar_solar_table(_airports(spark), years=(2019, 2020))
    lines = table._jdf.queryExecution().optimizedPlan().toString().split("\n")
    searched = [i for i, x in enumerate(lines) if "lambdafunction" in x]          # a plan's last lines run first
    assert searched and min(searched) > max(i for i, x in enumerate(lines) if "Generate" in x)
    keys = T.solar_table(spark.createDataFrame([(1, DAY, "APA", "APA", "1800.0", "1800.0")], FLIGHTS), _airports(spark))
    lines = keys._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert min(i for i, x in enumerate(lines) if "lambdafunction" in x) > min(i for i, x in enumerate(lines) if "Join" in x)
    assert table.rdd.getNumPartitions() > 1
