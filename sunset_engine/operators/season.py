"""Season filters.

F2 keeps dates strictly after a start day and strictly before an end day of the
row's own year. It compares ``month * 100 + day`` instead of building dates, so
no invalid calendar date can arise. When the caller knows the years, a plain
literal date range is added as well: that one is pushed into the Parquet scan
(row-group pruning, and partition pruning on date-partitioned tables).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col

# The reference season, August 1 to November 30 (both ends excluded for flights).
FALL_START = (8, 1)
FALL_END = (11, 30)
FALL_YEARS = (2018, 2020)
FALL_MONTHS = (8, 11)


def season_exclusive(date, start=FALL_START, end=FALL_END, years: tuple[int, int] | None = None) -> Column:
    """``start < (month, day) < end`` within each row's year (F2)."""
    d = as_col(date)
    md = F.month(d) * 100 + F.dayofmonth(d)
    cond = (md > start[0] * 100 + start[1]) & (md < end[0] * 100 + end[1])
    if years is not None:
        # whole years: the day test above does the rest, and any (month, day) pair is allowed
        cond = (d >= F.lit(dt.date(years[0], 1, 1))) & (d <= F.lit(dt.date(years[1], 12, 31))) & cond
    return cond


def season_inclusive(year, month, years=FALL_YEARS, months=FALL_MONTHS) -> Column:
    """Year and month both inside inclusive ranges."""
    return as_col(year).between(years[0], years[1]) & as_col(month).between(months[0], months[1])
