"""The file-to-file jobs chained as the reference runs them, on small hand-made files."""

import datetime as dt
import os
import re

import pytest

from sunset_engine.operators import traffic as T
from sunset_engine.plans import jobs
from sunset_engine.sources import csvio

DAY = dt.date(2019, 10, 1)
AIRPORTS = [("DEN", 39.861656, -104.673178), ("APA", 39.5701, -104.8490), ("ATL", 33.6367, -84.428101)]


def _hhmm(m):
    return f"{m // 60 * 100 + m % 60}.0"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("jobs"))
    # airports in the public airports layout
    head = ",".join(csvio.AIRPORT_COLUMNS)
    lines = [f'{i},K{c},large_airport,"{c}, Intl",{la},{lo},0,NA,US,US-XX,City,yes,K{c},"{c}",,,,'
             for i, (c, la, lo) in enumerate(AIRPORTS)]
    with open(os.path.join(d, "airports.csv"), "w") as f:
        f.write("\n".join([head, *lines]) + "\n")
    # sunset minutes of the day at each airport, DST-aware zone offsets
    probe = spark.createDataFrame([(i, DAY, c, c, "1.0", "1.0") for i, (c, _, _) in enumerate(AIRPORTS)],
                                  "event_id long, flight_date date, origin string, dest string, "
                                  "dep_time string, arr_time string")
    ap = csvio.read_airports(spark, os.path.join(d, "airports.csv"))
    sun = {r.airport_id: r.sunset_minute for r in T.solar_table(probe, ap, offset="timezone").collect()}
    # flights: DEN gets 3 near-sunset departures, APA 1 near-sunset arrival, ATL one far from sunset
    rows = [(DAY, "A, Inc.", "DEN", "ATL", _hhmm(sun["DEN"] + k), _hhmm(100)) for k in (-10, 0, 10)]
    rows += [(DAY, "B", "ATL", "APA", _hhmm(600), _hhmm(sun["APA"] + 5))]
    with open(os.path.join(d, "flights.csv"), "w") as f:
        f.write(",".join(csvio.FLIGHT_COLUMNS) + "\r\n")
        for day, airline, o, de, dep, arr in rows:
            f.write(f'{day},"{airline}",{o},{de},False,False,0,{dep},0,0,{arr}\r\n')
    # raw strike export, headerless: two near-sunset strikes at DEN, one at ATL far from sunset
    s = sun["DEN"]
    clock = lambda m: f"{m // 60:02d}:{m % 60:02d}"
    with open(os.path.join(d, "strikes.csv"), "w") as f:
        f.write(f'1,10/01/2019,10,2019,{clock(s - 5)},Dusk,"KDEN",DENVER,39.861656,-104.673178\n')
        f.write(f'2,10/01/2019,10,2019,{clock(s + 20)},Dusk,KDEN,DENVER,39.861656,-104.673178\n')
        f.write("3,10/01/2019,10,2019,09:00,Day,KATL,ATLANTA,33.6367,-84.428101\n")
        f.write("4,10/01/2017,10,2017,18:00,Day,KATL,ATLANTA,33.6367,-84.428101\n")
    # a raster cell table with density around Denver
    cells = spark.createDataFrame([(r, c, float((r + c) % 3)) for r in range(1255, 1275) for c in range(1610, 1635)],
                                  "row int, col int, value double")
    csvio.write_cells(cells, os.path.join(d, "cells"))
    with open(os.path.join(d, "codes.csv"), "w") as f:
        f.write("Code;Name\nDEN;Denver\nATL;Atlanta\n")
    return d


def test_flight_and_strike_chain(spark, files):
    out = os.path.join(files, "out")
    counts = jobs.strike_job(spark, os.path.join(files, "strikes.csv"), os.path.join(out, "strike_counts"))
    assert [(r.airport_id, r.strike_count) for r in counts.collect()] == [("KDEN", 2)]
    res = jobs.flight_job(spark, os.path.join(files, "flights.csv"), os.path.join(files, "airports.csv"),
                          os.path.join(out, "strike_counts"), out)
    assert {r.airport_id: r.flight_count for r in res["frequencies"].collect()} == {"DEN": 3, "APA": 1}
    assert [(r.airport_id, r.strike_ratio) for r in res["strike_per_flight"].collect()] == [
        ("DEN", pytest.approx(2 / 3))]
    top = spark.read.option("header", True).csv(os.path.join(out, "top_n")).collect()
    assert [r.airport_id for r in top] == ["DEN", "APA"]
    assert len(spark.read.option("header", True).csv(os.path.join(out, "top_and_bottom")).collect()) == 4
    rep = jobs.ratio_report(spark, os.path.join(out, "flight_frequencies"), os.path.join(out, "strike_counts"),
                            os.path.join(out, "ratio_report"))
    assert [(r.airport_id, r.strike_ratio) for r in rep.collect()] == [("APA", 0.0), ("DEN", pytest.approx(2 / 3))]

    with open(os.path.join(files, "zone_airports.csv"), "w") as f:
        f.write("airport_id,latitude_deg,longitude_deg\n" + "\n".join(f"{c},{la},{lo}" for c, la, lo in AIRPORTS))
    zonal = jobs.zonal_job(spark, os.path.join(files, "zone_airports.csv"), os.path.join(files, "cells"),
                           os.path.join(out, "zonal"))
    z = {r.airport_id: r.bird_population for r in zonal.collect()}
    assert set(z) == {"DEN", "APA", "ATL"} and 0.0 < z["DEN"] < 1.0 and z["ATL"] == 0.0
    table = jobs.training_job(spark, os.path.join(out, "zonal"), os.path.join(out, "strike_per_flight"),
                              os.path.join(out, "training"))
    assert [r.airport_id for r in table.collect()] == ["DEN"]


def test_code_check(spark, files):
    missing = jobs.code_check(spark, os.path.join(files, "codes.csv"), os.path.join(files, "flights.csv"))
    assert [r.code for r in missing.collect()] == ["APA"]


def test_stats_and_model_jobs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "training.csv")
    with open(path, "w") as f:
        f.write("airport_id,bird_population,bird_strike_count,flight_count,bird_flight_ratio\r\n")
        for i in range(40):
            f.write(f"A{i:02d},{(i % 7) / 7:.6f},{i % 3},{100 + 10 * i},{(i % 7) / 700 + 0.001:.6f}\r\n")
    s = jobs.stats_job(spark, path).first()
    assert s.n == 40 and 0.9 < s.pearson_r <= 1.0 and s.p_value < 1e-6
    pred, metrics = jobs.model_job(spark, path, os.path.join(tmp_dir, "run"), cross_validate=False)
    assert pred.count() > 0 and metrics["rmse"] >= 0
    assert os.path.isdir(os.path.join(tmp_dir, "run-model"))


def test_ingest_prunes_months(spark, files, tmp_dir):
    out = os.path.join(tmp_dir, "flights_pq")
    jobs.ingest_flights(spark, os.path.join(files, "flights.csv"), out)
    assert os.path.isdir(os.path.join(out, "flight_year=2019", "flight_month=10"))
    t = spark.read.parquet(out)
    near = T.near_sunset_flights(t, csvio.read_airports(spark, os.path.join(files, "airports.csv")),
                                 years=(2018, 2020), offset="timezone")
    plan = near._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert re.search(r"flight_month#\d+ >= 8\)", pruned) and "isnotnull(flight_year" in pruned
    assert sorted(r.airport_id for r in near.collect()) == ["APA", "DEN", "DEN", "DEN"]


def test_command_line(spark, files, tmp_dir, capsys):
    from sunset_engine.__main__ import main

    out = os.path.join(tmp_dir, "cli")
    assert main(["strikes", os.path.join(files, "strikes.csv"), os.path.join(out, "counts")], spark) == 0
    assert main(["flights", os.path.join(files, "flights.csv"), os.path.join(files, "airports.csv"),
                 os.path.join(out, "counts"), out, "--n", "1"], spark) == 0
    top = spark.read.option("header", True).csv(os.path.join(out, "top_n")).collect()
    assert [r.airport_id for r in top] == ["DEN"]
    assert main(["codes", os.path.join(files, "codes.csv"), os.path.join(files, "flights.csv")], spark) == 0
    assert capsys.readouterr().out.split() == ["APA"]


def test_command_line_stats_model_codes_ingest(spark, files, tmp_dir, capsys):
    import json

    from sunset_engine.__main__ import main

    path = os.path.join(tmp_dir, "training.csv")
    with open(path, "w") as f:
        f.write("airport_id,bird_population,bird_strike_count,flight_count,bird_flight_ratio\n")
        for i in range(30):
            f.write(f"A{i:02d},{(i % 5) / 5:.4f},{i % 3},{50 + 7 * i},{(i % 5) / 500 + 0.002:.6f}\n")
    assert main(["stats", path], spark) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["n"] == 30 and set(stats) >= {"pearson_r", "p_value", "slope", "intercept", "r2"}
    assert main(["model", path, os.path.join(tmp_dir, "m"), "--no-cv"], spark) == 0
    metrics = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(metrics) == {"rmse", "mse", "mae", "r2"}
    tz = os.path.join(tmp_dir, "tz.csv")
    with open(tz, "w") as f:
        f.write('code,zone\n"DEN","America/Denver"\n"XYZ","America/Chicago"\n')
    assert main(["codes", os.path.join(files, "codes.csv"), tz, "--timezones"], spark) == 0
    assert capsys.readouterr().out.split() == ["XYZ"]
    out = os.path.join(tmp_dir, "pq")
    assert main(["ingest", os.path.join(files, "flights.csv"), out], spark) == 0
    assert spark.read.parquet(out).count() == 4


def test_command_line_flights_from_ingested_parquet(spark, files, tmp_dir):
    from sunset_engine.__main__ import main

    out = os.path.join(tmp_dir, "run")
    pq = os.path.join(tmp_dir, "flights_pq")
    assert main(["ingest", os.path.join(files, "flights.csv"), pq], spark) == 0
    assert main(["strikes", os.path.join(files, "strikes.csv"), os.path.join(out, "counts")], spark) == 0
    assert main(["flights", pq, os.path.join(files, "airports.csv"), os.path.join(out, "counts"), out,
                 "--parquet"], spark) == 0
    freq = spark.read.option("header", True).csv(os.path.join(out, "flight_frequencies")).collect()
    assert {r.airport_id: int(r.flight_count) for r in freq} == {"DEN": 3, "APA": 1}


def test_flights_of_other_years_are_kept(spark, files, tmp_dir):
    """A 2021 flight near sunset counts, in the job and on the command line, unless years are given."""
    from sunset_engine.__main__ import main

    path, zones = os.path.join(tmp_dir, "flights.csv"), os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as f:
        f.write(",".join(csvio.FLIGHT_COLUMNS) + "\n2021-10-01,A,DEN,XXX,False,False,0,1841.0,0,0,\n")
    with open(zones, "w") as f:
        f.write('code,zone\n"DEN","America/Denver"\n')
    counts = os.path.join(tmp_dir, "counts")
    assert main(["strikes", os.path.join(files, "strikes.csv"), counts, "--timezones", zones], spark) == 0
    for extra, expected in (([], 1), (["--years", "2018", "2020"], 0), (["--timezones", zones], 1)):
        out = os.path.join(tmp_dir, "out" + "".join(extra).replace("/", "_"))
        assert main(["flights", path, os.path.join(files, "airports.csv"), counts, out, *extra], spark) == 0
        assert spark.read.option("header", True).csv(os.path.join(out, "sunset_flights")).count() == expected


def test_ratio_report_file_ends_with_nulls(spark, tmp_dir):
    df = spark.createDataFrame([("A", None), ("B", 2.0), ("C", 1.0)], "airport_id string, strike_ratio double")
    csvio.write_sorted_report(df.repartition(3), os.path.join(tmp_dir, "r"), ["strike_ratio"])
    part = [f for f in os.listdir(os.path.join(tmp_dir, "r")) if f.endswith(".csv")]
    assert len(part) == 1
    with open(os.path.join(tmp_dir, "r", part[0])) as f:
        assert [line.split(",")[0] for line in f.read().split()[1:]] == ["C", "B", "A"]


def test_ingest_leaves_splitting_to_spark(spark, files):
    """The write asks for a rebalance by month, which has no fixed number of buckets."""
    f = csvio.read_flights(spark, os.path.join(files, "flights.csv")).selectExpr("*", "year(flight_date) y", "month(flight_date) m")
    assert "REBALANCE_PARTITIONS_BY_COL" in f.hint("rebalance", "y", "m")._jdf.queryExecution().executedPlan().toString()


def test_written_tables_have_no_mark_of_success(spark):
    """Each file made on a local file system starts a process; nothing looks for the mark."""
    import os

    from sunset_engine.operators.joins import materialize

    df = materialize(spark.range(5), "marks")
    assert df.count() == 5 and "_SUCCESS" not in os.listdir(os.path.dirname(df.inputFiles()[0].removeprefix("file://")))
