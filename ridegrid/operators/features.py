"""Model features of the hourly series: lags and Fourier terms per location.

Lags use a RANGE frame on epoch seconds, so a lag of k hours is the value
exactly k hours earlier (null when that hour is missing, e.g. across month
grids), not k rows earlier.  One window sort serves every lag.  The window is
partitioned by location: its size is the number of hours in the series,
bounded by the calendar, not by trip volume.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds

DEFAULT_LAGS = (1, 24, 168)
DEFAULT_PERIODS = (24, 12, 168)


def lag_features(series: DataFrame, lags=DEFAULT_LAGS, hour_col: str = "pickup_hour",
                 loc_col: str = "pickup_location_id", value_col: str = "rides") -> DataFrame:
    t = epoch_seconds(hour_col)
    w = Window.partitionBy(loc_col).orderBy(t)
    out = series
    for k in lags:
        off = -3600 * int(k)
        out = out.withColumn(f"lag_{k}", F.max(value_col).over(w.rangeBetween(off, off)))
    return out


def _round4(c):
    # Sums that cancel to ~0 can round to -0.0 or 0.0 depending on the order of
    # addition; adding 0.0 maps -0.0 to 0.0 so the result is order-independent.
    return F.round(c, 4) + F.lit(0.0)


def fourier_features(series: DataFrame, periods=DEFAULT_PERIODS, hour_col: str = "pickup_hour",
                     loc_col: str = "pickup_location_id", value_col: str = "rides") -> DataFrame:
    """Discrete Fourier coefficients of each location's series at given periods.

    For period P (hours), with t the absolute hour index (epoch hours), reduced
    mod P first so the angle stays small and exact:
      cos_coef = sum(x * cos(2 pi (t mod P) / P)), sin_coef likewise with sin,
      amplitude = 2 / n * sqrt(cos_coef^2 + sin_coef^2).
    Plain grouped sums (partial aggregation), no per-group Python.
    """
    t = F.floor(epoch_seconds(hour_col) / 3600).cast("bigint")
    x = F.col(value_col).cast("double")
    aggs = [F.count(F.lit(1)).alias("n_hours")]
    for p in periods:
        ang = F.lit(2 * math.pi) * (t % p) / p
        aggs += [F.sum(x * F.cos(ang)).alias(f"cos_{p}"), F.sum(x * F.sin(ang)).alias(f"sin_{p}")]
    agg = series.groupBy(loc_col).agg(*aggs)
    stacked = None
    for p in periods:
        one = agg.select(
            loc_col, F.lit(p).alias("period_hours"),
            _round4(F.col(f"cos_{p}")).alias("cos_coef"),
            _round4(F.col(f"sin_{p}")).alias("sin_coef"),
            _round4(F.sqrt(F.col(f"cos_{p}") ** 2 + F.col(f"sin_{p}") ** 2) * 2
                    / F.col("n_hours")).alias("amplitude"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


def calendar_features(series: DataFrame, hour_col: str = "pickup_hour") -> DataFrame:
    """Hour of day, day of week and the Fourier basis terms of each row."""
    t = F.floor(epoch_seconds(hour_col) / 3600).cast("bigint")
    out = series.withColumn("hour_of_day", F.hour(hour_col)).withColumn(
        "day_of_week", F.dayofweek(hour_col))
    for p in DEFAULT_PERIODS:
        ang = F.lit(2 * math.pi) * (t % p) / p
        out = out.withColumn(f"cos_{p}", F.cos(ang)).withColumn(f"sin_{p}", F.sin(ang))
    return out
