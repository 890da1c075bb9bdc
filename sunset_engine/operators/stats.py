"""Correlation, least-squares line and error metrics as aggregates.

Every statistic is one distributed aggregate (partial per task, one final row).
Per-row fitted values use the one-row fit as a scalar subquery, not a join.
ANSI-safe: a constant column gives NULL instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunset_engine.functions.columns import as_col


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r of the non-null pairs, NULL for a constant column."""
    p = _pairs(df, x, y)
    return p.agg(F.count(F.lit(1)).alias("n"),
                 F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("pearson_r"))


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope * x + intercept and its R^2."""
    p = _pairs(df, x, y)
    return p.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                 F.regr_r2("y", "x").alias("r2"))


def summary(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r and the least-squares line in one aggregate pass."""
    p = _pairs(df, x, y)
    return p.agg(F.count(F.lit(1)).alias("n"),
                 F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("pearson_r"),
                 F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                 F.regr_r2("y", "x").alias("r2"))


def fit_residuals(df: DataFrame, x: str, y: str, keys: list[str]) -> DataFrame:
    """Each row with its fitted value and residual ``y - fitted``."""
    fit = _pairs(df, x, y).select(F.struct(F.regr_slope("y", "x").alias("b"),
                                           F.regr_intercept("y", "x").alias("a")).alias("f")).scalar()
    fitted = F.col(x).cast("double") * fit.getField("b") + fit.getField("a")
    return df.select(*keys, F.col(x), F.col(y), fitted.alias("fitted"),
                     (F.col(y).cast("double") - fitted).alias("residual"))


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MSE, MAE and R^2 = 1 - SS_res / SS_tot of predictions, one aggregate pass."""
    e = F.col(label).cast("double") - F.col(prediction).cast("double")
    ss_tot = F.var_pop(F.col(label).cast("double")) * F.count(F.lit(1))
    return pred.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                    (F.lit(1.0) - F.try_divide(F.sum(e * e), ss_tot)).alias("r2"))


# Steps of the tail integral (Simpson's rule, an even number) and its width in units where the tail has fallen
# by exp(-41).
TAIL_STEPS = 1200


def t_test_p_value(r, n) -> Column:
    """Two-sided p-value of Pearson's r under H0: rho = 0 (Student t with n - 2 degrees of freedom), one formula for all n.

    With d degrees of freedom and s = sqrt(d ln(1 + t^2 / d)) the density of t becomes
    exp(-s^2 / 2) sqrt(v / (1 - exp(-v))) up to a factor, v = s^2 / d: nearly normal, for any d.
    The p-value is its integral from s on over that from 0 on, both by Simpson's rule. Since
    t^2 / d = r^2 / (1 - r^2), s is sqrt(-d ln(1 - r^2)). NULL below three pairs or without r.
    """
    r, d = as_col(r).cast("double"), as_col(n).cast("double") - 2.0

    def tail(s: Column) -> Column:
        """Integral of the density from ``s`` on, times exp(s^2 / 2)."""
        step = F.lit(41.0) / (s + 4.5) / (TAIL_STEPS / 2) / 2.0

        def height(i: Column) -> Column:
            y = step * i
            v = (s + y) * (s + y) / d
            shape = F.when(v < 1e-8, F.lit(1.0) + v / 2.0).otherwise(v / -F.expm1(-v))
            return F.exp(-s * y - y * y / 2.0) * F.sqrt(shape)

        weight = lambda i: F.when((i == 0) | (i == TAIL_STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return F.aggregate(F.sequence(F.lit(0), F.lit(TAIL_STEPS)), F.lit(0.0), lambda a, i: a + weight(i) * height(i)) * step

    s = F.sqrt(-d * F.log1p(-r * r))
    p = F.exp(-s * s / 2.0) * tail(s) / tail(F.lit(0.0))
    return F.when(r.isNull() | (d < 1), F.lit(None).cast("double")).when(F.abs(r) >= 1.0, 0.0).otherwise(F.least(F.lit(1.0), p))


def pearson_p_value(df: DataFrame, x: str, y: str) -> DataFrame:
    """n, Pearson r and its two-sided p-value (A9): one aggregate and column math on its one row."""
    return pearson(df, x, y).withColumn("p_value", t_test_p_value("pearson_r", "n"))
