"""Seasonal trend forecasts for many series at once, and driver correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyline.functions.columns import month_of


def linear_trend(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares `slope` and `intercept` per key, with the number of points `n`.

    A series of one point has slope 0 and its value as intercept.
    """
    return df.groupBy(*keys).agg(
        F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("intercept"),
        F.count(F.lit(1)).alias("n"))


def correlate(df: DataFrame, x: str, y: str, keys: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Pearson `correlation` of two columns per key over the rows that have both, and the
    number of such rows as `periods`."""
    return (df.dropna(subset=[x, y]).groupBy(*keys)
            .agg(F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), digits).alias("correlation"),
                 F.count(F.lit(1)).alias("periods")))


def revenue_forecast(series: DataFrame, keys: Sequence[str] = (), horizon: int = 6,
                     month: str = "month", value: str = "revenue") -> DataFrame:
    """Linear trend times mean seasonal ratio per calendar month, never below zero.

    One fit per series named by `keys`; the trend runs over the row number of the month.
    A calendar month without history has factor 1. A single observation gives a level.
    """
    keys = list(keys)
    points = (series.where(F.col(value).isNotNull())
              .select(*keys, F.col(month).alias("month"), F.col(value).cast("double").alias("y"))
              .withColumn("x", (F.row_number().over(Window.partitionBy(*keys).orderBy("month")) - 1)
                          .cast("double")))
    # a constant key lets a single series join its one-row fit like any other
    points = points.withColumn("_s", F.lit(0))
    every = [*keys, "_s"]
    last = points.groupBy(*every).agg(F.max("month").alias("last_month"))
    fit = linear_trend(points, "y", "x", every).join(last, every)
    trend = F.col("intercept") + F.col("slope") * F.col("x")
    seasonal = (points.join(fit, every)
                .withColumn("share", F.col("y") / F.when(trend == 0, 1.0).otherwise(trend))
                .groupBy(*every, F.month("month").alias("m")).agg(F.avg("share").alias("factor")))
    ahead = (fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
             .withColumn("target", F.add_months("last_month", F.col("h")))
             .withColumn("m", F.month("target"))
             .withColumn("base", F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("h"))))
    estimate = F.greatest(F.col("base") * F.coalesce("factor", F.lit(1.0)), F.lit(0.0))
    return (ahead.join(seasonal, [*every, "m"], "left")
            .select(*keys, F.date_format("target", "yyyy-MM").alias("month"),
                    F.round(estimate, 2).alias("revenue_forecast"), F.lit("forecast").alias("type")))


def monthly_driver(df: DataFrame, date_col: str, value: str, driver: str) -> DataFrame:
    """A driver's monthly sums as (period, driver, value)."""
    return (df.where(F.col(date_col).isNotNull()).groupBy(month_of(date_col).alias("period"))
            .agg(F.sum(value).alias("value"))
            .select("period", F.lit(driver).alias("driver"), "value"))


def driver_correlations(revenue: DataFrame, drivers: DataFrame, min_periods: int = 4,
                        keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of each driver with revenue over the periods both have.

    `revenue` is (keys..., period, revenue), `drivers` (keys..., period, driver, value), at
    any period grain. Drivers with fewer than `min_periods` common periods are left out.
    """
    joined = revenue.join(drivers, [*keys, "period"])
    return (correlate(joined, "revenue", "value", [*keys, "driver"])
            .where(F.col("periods") >= min_periods))
