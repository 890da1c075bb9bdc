import datetime as dt

from pyspark.sql import functions as F

from sunset_engine.functions.timeparse import clock_to_minutes, hhmm_to_minutes, parse_iso_date, parse_us_date


def test_hhmm_decimal_times(spark):
    rows = [("1253.0",), ("5.0",), ("2400.0",), ("1275.0",), ("",), ("NA.0",), ("1253",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(hhmm_to_minutes("t").alias("m"), hhmm_to_minutes("t", compat=True).alias("c")).collect()
    assert [r.m for r in out] == [773, 5, 1440, 795, None, None, 773, None]
    # the compat form cuts the last two characters blindly: "1253" -> "12" -> 12 minutes
    assert [r.c for r in out] == [773, 5, 1440, 795, None, None, 12, None]


def test_clock_times(spark):
    df = spark.createDataFrame([("18:41",), (" 07:05 ",), ('"19:00"',), (" ",), ("",), ("ab:cd",), ("24:00",)],
                               "t string")
    assert [r.m for r in df.select(clock_to_minutes("t").alias("m")).collect()] == [
        1121, 425, 1140, None, None, None, 1440]


def test_dates(spark):
    df = spark.createDataFrame([("2019-09-14", "9/4/2019"), ("2019-13-01", "09/04/2019"), ("x", "13/01/2019")],
                               "a string, b string")
    out = df.select(parse_iso_date("a").alias("a"), parse_us_date("b").alias("b")).collect()
    assert out[0].a == dt.date(2019, 9, 14) and out[0].b == dt.date(2019, 9, 4)
    assert out[1].a is None and out[1].b == dt.date(2019, 9, 4)
    assert out[2].a is None and out[2].b is None


def test_no_python_udf_in_parsing_plan(spark):
    df = spark.createDataFrame([("1253.0",)], "t string").select(hhmm_to_minutes(F.col("t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
