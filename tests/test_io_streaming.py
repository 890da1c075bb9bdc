import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sunset_engine.sources import csvio
from sunset_engine.streaming import near_sunset as S


def _write(path, text, newline="\n"):
    with open(path, "w", newline="") as f:
        f.write(text.replace("\n", newline))


def test_flights_csv_quoted_comma_and_crlf(spark, tmp_dir):
    p = os.path.join(tmp_dir, "flights.csv")
    _write(p, ",".join(csvio.FLIGHT_COLUMNS) + ",Extra\n"
           '2019-09-14,"A, Inc.",DEN,ATL,False,False,1800,1812.0,12.0,12.0,2301.0,x\n'
           "2019-09-15,B,ATL,DEN,False,False,0600,,0.0,0.0,0822.0,y\n", newline="\r\n")
    rows = csvio.read_flights(spark, p).orderBy("flight_date").collect()
    assert [(r.flight_date, r.origin, r.dest, r.dep_time, r.arr_time) for r in rows] == [
        (dt.date(2019, 9, 14), "DEN", "ATL", "1812.0", "2301.0"),
        (dt.date(2019, 9, 15), "ATL", "DEN", "", "0822.0")]


def test_airports_csv_key_and_empty_code(spark, tmp_dir):
    p = os.path.join(tmp_dir, "airports.csv")
    head = ",".join(csvio.AIRPORT_COLUMNS)
    line = '1,KDEN,large_airport,"Denver, Intl",39.86,-104.67,5431,NA,US,US-CO,Denver,yes,KDEN,"DEN",,,,'
    empty = '2,00A,heliport,Pad,40.07,-74.93,11,NA,US,US-PA,Bensalem,no,00A,"",,,,'
    _write(p, "\n".join([head, line, empty]) + "\n")
    rows = csvio.read_airports(spark, p).collect()
    assert [(r.airport_id, r.latitude_deg, r.type) for r in rows] == [("DEN", "39.86", "large_airport"),
                                                                       ("", "40.07", "heliport")]


def test_strikes_by_position_headerless(spark, tmp_dir):
    p = os.path.join(tmp_dir, "strikes.csv")
    _write(p, '1,09/04/2019,9,2019,18:40,Dusk,"KDEN",DENVER,39.86,-104.67\n'
              "2,9/5/2019,9,2019, ,Night,KATL,ATLANTA,,-84.4\n")
    rows = csvio.read_strikes(spark, p).orderBy("incident_date").collect()
    assert rows[0].incident_date == "09/04/2019" and rows[0].incident_year == 2019 and rows[0].time == "18:40"
    assert rows[1].airport_latitude is None and rows[1].incident_month == 9


def test_code_lists(spark, tmp_dir):
    p = os.path.join(tmp_dir, "codes.csv")
    _write(p, "Code;Name\nDEN;Denver\nATL;Atlanta\n")
    assert [r.code for r in csvio.read_code_list(spark, p).collect()] == ["DEN", "ATL"]
    t = os.path.join(tmp_dir, "tz.csv")
    _write(t, 'code,tz\n"DEN","America/Denver"\n"ZZZ","America/New_York"\n')
    assert [r.code for r in csvio.read_code_list(spark, t, sep=",").collect()] == ["DEN", "ZZZ"]


def test_single_file_sink_modes(spark, tmp_dir):
    df = spark.createDataFrame([("DEN", 3), ("ATL", 1)], "airport_id string, flight_count long")
    out = os.path.join(tmp_dir, "report")
    csvio.write_single_csv(df, out)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0])) as f:
        assert f.readline().strip() == "airport_id,flight_count"
    with pytest.raises(AnalysisException):
        csvio.write_single_csv(df, out)
    csvio.write_sorted_report(df, out, ["flight_count"])
    back = spark.read.option("header", True).csv(out).collect()
    assert [r.airport_id for r in back] == ["ATL", "DEN"]


def test_cells_sink_partitions_by_tile(spark, tmp_dir):
    cells = spark.createDataFrame([(0, 0, 1.0), (300, 5, 2.0)], "row int, col int, value double")
    out = os.path.join(tmp_dir, "cells")
    csvio.write_cells(cells, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("tile_row=")) == ["tile_row=0", "tile_row=1"]
    assert spark.read.parquet(out).where("tile_row = 1").count() == 1


def test_stream_of_flight_files(spark, tmp_dir):
    from sunset_engine.operators import traffic as T

    src = os.path.join(tmp_dir, "in")
    airports = spark.createDataFrame([("APA", "39.5701", "-104.8490")],
                                     "airport_id string, latitude_deg string, longitude_deg string")
    day = dt.date(2019, 10, 1)
    schema = "event_id long, flight_date date, origin string, dest string, dep_time string, arr_time string"
    probe = T.solar_table(spark.createDataFrame([(1, day, "APA", "APA", "1.0", "1.0")], schema), airports)
    s = probe.first().sunset_minute
    hhmm = f"{s // 60 * 100 + s % 60}.0"
    for i in range(2):
        spark.createDataFrame([(10 * i + j, day, "APA", "APA", hhmm, "0.0") for j in range(3)], schema) \
            .write.mode("append").parquet(src)
    q = S.start_counts(spark, src, spark.read.parquet(src).schema, airports, os.path.join(tmp_dir, "out"),
                       os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    totals = S.running_totals(spark, os.path.join(tmp_dir, "out")).collect()
    assert [(r.airport_id, r.flight_count) for r in totals] == [("APA", 6)]
    assert q.exception() is None
    # a restart on the same checkpoint processes nothing twice; a new file is counted once
    spark.createDataFrame([(100, day, "APA", "APA", hhmm, "0.0")], schema).write.mode("append").parquet(src)
    for _ in range(2):
        q = S.start_counts(spark, src, spark.read.parquet(src).schema, airports, os.path.join(tmp_dir, "out"),
                           os.path.join(tmp_dir, "ckpt"))
        q.awaitTermination(120)
    totals = S.running_totals(spark, os.path.join(tmp_dir, "out")).collect()
    assert [(r.airport_id, r.flight_count) for r in totals] == [("APA", 7)]


def test_profile(spark):
    from sunset_engine.operators.quality import profile

    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    r = profile(df).first()
    assert (r.n_rows, r.nulls_a, r.nulls_b) == (3, 1, 2)
    assert profile(df.where(F.lit(False))).first().n_rows == 0
