"""Delimited-text helpers as built-in Column expressions.

With named CSV columns these are rarely needed; they exist for inputs that
arrive as raw lines and for writing keyed text lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col


def field(line, i: int, sep: str = ",") -> Column:
    """0-based field ``i`` of a delimited line, trailing empty fields kept."""
    return F.split(as_col(line), sep, -1).getItem(i)


def strip_quotes(c) -> Column:
    """Remove double quotes and surrounding blanks."""
    return F.trim(F.regexp_replace(as_col(c), '"', ""))


def drop_first_char(c) -> Column:
    """Everything after the first character."""
    return F.substring(as_col(c), 2, 2147483647)


def before_first(c, sep: str = ",") -> Column:
    """Text up to the first separator."""
    return F.substring_index(as_col(c), sep, 1)


def after_last(c, sep: str = ",") -> Column:
    """Text after the last separator."""
    return F.substring_index(as_col(c), sep, -1)


def key_line(key, value, sep: str = ",") -> Column:
    """``key<sep>value`` output line (K9)."""
    return F.concat_ws(sep, as_col(key).cast("string"), as_col(value).cast("string"))


def csv_fields(line, schema: str, sep: str = ",") -> Column:
    """The fields of a delimited text column as a struct of ``schema`` (S6): quotes may hold the separator, doubled quotes one quote.

    A field that does not fit its type is NULL, as are fields that are missing; a NULL line is NULL.
    """
    return F.from_csv(as_col(line), F.lit(schema), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
