"""Small Column helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def pmod(x, m: float) -> Column:
    """Positive remainder of a double (``pmod`` keeps the sign of the divisor)."""
    return F.pmod(as_col(x), F.lit(float(m)))


def safe_ratio(num, den) -> Column:
    """``num / den`` as double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def nan_to_zero(c) -> Column:
    """NULL and NaN become 0.0."""
    return F.coalesce(F.nanvl(as_col(c).cast("double"), F.lit(0.0)), F.lit(0.0))


def to_double(c) -> Column:
    """Text (quotes and blanks stripped) to double; bad values give NULL."""
    return F.trim(F.regexp_replace(as_col(c).cast("string"), '"', "")).try_cast("double")


def finite(c) -> Column:
    """True when the double is neither NULL, NaN nor infinite."""
    x = as_col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def round_significant(c, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (comparing large sums across engines).

    Scales by the decimal exponent, rounds, scales back; 0 and NULL pass through.
    """
    x = as_col(c).cast("double")
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - (digits - 1))
    return F.when((x == 0) | x.isNull(), x).otherwise(F.round(x / scale) * scale)
