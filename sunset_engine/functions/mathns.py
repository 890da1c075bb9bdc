"""Math namespace over Spark Columns.

The geodesy formulas in ``geo.py`` are written against a namespace ``m`` with
``m.sin``, ``m.sqrt``, ``m.atan2`` ... . ``SPARK`` maps them to built-in Spark
functions.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

SPARK = SimpleNamespace(
    sin=F.sin, cos=F.cos, tan=F.tan, asin=F.asin, acos=F.acos, atan=F.atan,
    atan2=lambda y, x: F.atan2(y, x),
    sqrt=F.sqrt, ln=lambda x: F.log(x), radians=F.radians, degrees=F.degrees,
    lit=lambda x: F.lit(float(x)), col=F.col,
    trunc_int=lambda x: x.cast("int"),
)
