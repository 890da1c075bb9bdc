"""Date and time-of-day parsing as built-in Column expressions.

Input text is never cast with a plain ``cast``: Spark 4 runs in ANSI mode, where a
bad value fails the job, so every parse is a ``try_*`` that yields NULL instead.
Times of day become *linear* minutes (``hour * 60 + minute``) without a modulo,
so ``2400`` is 1440 and ``1275`` is 795, as a lenient clock parser reads them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col


def parse_iso_date(c) -> Column:
    """``yyyy-MM-dd`` text (anything after the tenth character ignored) to DATE."""
    return F.try_to_date(F.substring(as_col(c), 1, 10), "yyyy-MM-dd")


def parse_us_date(c) -> Column:
    """``MM/dd/yyyy`` text to DATE; one-digit month and day are accepted."""
    return F.try_to_date(F.trim(as_col(c)), "M/d/yyyy")


def hhmm_number(c, compat: bool = False) -> Column:
    """The integer ``hhmm`` inside a decimal-time text such as ``1253.0``.

    Default: the text must parse as a number; its integer part is the time.
    ``compat=True`` drops the last two characters blindly and parses the rest,
    so ``"1253"`` becomes 12. Unparseable text gives NULL.
    """
    text = F.trim(as_col(c))
    if compat:
        cut = F.substring(text, F.lit(1), F.length(text) - 2)
        return cut.try_cast("int")
    return text.try_cast("double").try_cast("int")


def hhmm_to_minutes(c, compat: bool = False) -> Column:
    """Decimal-time text ``hhmm.0`` to linear minutes of day."""
    t = hhmm_number(c, compat)
    return (F.floor(t / 100) * 60 + t % 100).cast("int")


def clock_to_minutes(c) -> Column:
    """``HH:mm`` text to linear minutes of day; blank or malformed gives NULL (D3)."""
    text = F.trim(F.regexp_replace(as_col(c), '"', ""))
    hours = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int")
    minutes = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(F.instr(text, ":") > 0, hours * 60 + minutes)
