"""Apply a chain of named column steps, one projection per dependency level.

Long formulas (sunset, projection, geodesic) are written as ordered steps
``(name, fn)``; ``fn(m, c)`` builds the Column from the math namespace ``m`` and
references to earlier columns ``c(name)``. Each dependency level becomes one projection, so
Catalyst keeps every intermediate once and the chain stays inside one
whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunset_engine.functions.mathns import SPARK


def apply_steps(df: DataFrame, steps: list, drop_prefix: str | None = None) -> DataFrame:
    """Add the steps' columns.

    A step is ``(name, fn)`` or a list of independent ``(name, fn)`` pairs. All of them are
    given to Spark in one ``select`` whose later columns name earlier ones; Spark makes one
    projection per dependency level of it, and the plan is analysed once, not once a level.
    Columns starting with ``drop_prefix`` are dropped at the end, and Catalyst prunes
    them after their last use. A step replaces a column of its name.
    """
    pairs = [pair for step in steps for pair in (step if isinstance(step, list) else [step])]
    made = [name for name, _ in pairs]
    keep = [c for c in df.columns if c not in made]
    out = df.select(*keep, *[fn(SPARK, F.col).alias(name) for name, fn in pairs])
    return out.select(*keep, *[n for n in made if not (drop_prefix and n.startswith(drop_prefix))])


def computed(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows; nothing that follows is merged with the formulas of ``columns``.

    Tests of a column are otherwise pushed below its formula, whose text they repeat at every level, and long
    chains are compiled into one method; the JVM only interprets methods of more than 8000 bytes.
    """
    for c in columns:
        df = df.withColumn(c, F.explode(F.array(c)))
    return df


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet ``condition``, tested above the formulas of its columns (see ``computed``)."""
    return computed(df.withColumn("_holds", condition), "_holds").where("_holds").drop("_holds")


def step_value(steps: list, out: str) -> Column:
    """The value of step ``out`` as one expression in which every step is computed once.

    For formulas inside a higher-order function, where there are no columns to add: each step is bound
    as the variable of a one-element ``transform``.
    """
    pairs = [pair for step in steps for pair in (step if isinstance(step, list) else [step])]

    def bound(i: int, made: dict[str, Column]) -> Column:
        name, fn = pairs[i]
        value = fn(SPARK, made.__getitem__)
        if name == out:
            return value
        return F.get(F.transform(F.array(value), lambda v: bound(i + 1, {**made, name: v})), F.lit(0))

    return bound(0, {})
