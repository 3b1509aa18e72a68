"""Queries the dashboard and analysts run against the served tables.

``demand`` is the hourly series (pickup_hour, pickup_location_id, rides, ...)
and ``predictions`` the forecasts (pickup_location_id, prediction_datetime,
predicted_rides).  Location arguments are optional: ``None`` answers for all
locations at once (the per-location form is the same plan with one more
equality filter, pushed into the scan).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import (ceil_hour, floor_hour, format_hour, hour_band, minus_days,
                              utc_to_local)

DAYS_BACK_START = 365
DAYS_BACK_END = 358


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(v).cast("timestamp_ntz")


def _month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def in_time_range(df: DataFrame, time_col: str, start: Column, end: Column) -> DataFrame:
    """``start <= time_col <= end``; on a (year, month)-partitioned table also a
    partition predicate derived from the bounds, so only those month folders are read.
    With literal bounds both sides constant-fold: the time range is pushed into the
    Parquet scan and the month range prunes partitions.
    """
    out = df.where(F.col(time_col).between(start, end))
    if "year" in df.columns and "month" in df.columns:
        idx = F.col("year").cast("int") * 12 + F.col("month").cast("int")
        # a row without keys is judged by its time alone
        out = out.where(idx.isNull() | idx.between(_month_index(start), _month_index(end)))
    return out


def demand_range(demand: DataFrame, start, end, cols: list[str] | None = None) -> DataFrame:
    """Rows with ``start <= pickup_hour <= end`` (inclusive), ordered by hour."""
    cols = cols or demand.columns
    return (in_time_range(demand, "pickup_hour", _ts(start), _ts(end))
            .select(*cols).orderBy("pickup_hour", *[c for c in cols if c != "pickup_hour"]))


def week_window(anchor_utc) -> tuple[Column, Column]:
    """Same week last year, in New York wall-clock time, for a UTC 'now'.

    start = (now - 365 days) floored to the hour; end = (now - 358 days) rounded
    up to the next whole hour unless already whole.  Day arithmetic is on the
    wall clock, as the original dashboard did with zone-aware datetimes.
    """
    local = utc_to_local(_ts(anchor_utc))
    return (floor_hour(minus_days(local, DAYS_BACK_START)),
            ceil_hour(minus_days(local, DAYS_BACK_END)))


def location_week(demand: DataFrame, predictions: DataFrame, anchor_utc,
                  location: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct (hour, rides) and (hour, predicted) pairs inside the week window."""
    start, end = week_window(anchor_utc)
    a = in_time_range(demand, "pickup_hour", start, end)
    p = in_time_range(predictions, "prediction_datetime", start, end)
    if location is not None:
        a = a.where(F.col("pickup_location_id") == location)
        p = p.where(F.col("pickup_location_id") == location)
    actual = (a.select("pickup_location_id", "pickup_hour", "rides").distinct()
              .orderBy("pickup_location_id", "pickup_hour", "rides"))
    predicted = (p.select("pickup_location_id", "prediction_datetime", "predicted_rides")
                 .distinct().orderBy("pickup_location_id", "prediction_datetime",
                                     "predicted_rides"))
    return actual, predicted


def location_series(demand: DataFrame, predictions: DataFrame,
                    location: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Actual and predicted series with the time as ``yyyy-MM-dd HH:mm:ss`` text."""
    a, p = demand, predictions
    if location is not None:
        a = a.where(F.col("pickup_location_id") == location)
        p = p.where(F.col("pickup_location_id") == location)
    actual = a.select("pickup_location_id", format_hour("pickup_hour").alias("pickup_hour"),
                      "rides").orderBy("pickup_location_id", "pickup_hour")
    predicted = p.select("pickup_location_id",
                         format_hour("prediction_datetime").alias("prediction_datetime"),
                         "predicted_rides").orderBy("pickup_location_id", "prediction_datetime")
    return actual, predicted


def run_query(spark: SparkSession, query: str, args: dict | None = None,
              **frames: DataFrame) -> DataFrame:
    """Parametrised SQL: ``:name`` markers bound from ``args``; ``{name}`` frames."""
    return spark.sql(query, args=args or {}, **frames)


def location_summary(demand: DataFrame) -> DataFrame:
    """Per location: row count, first and last hour, total rides."""
    return demand.groupBy("pickup_location_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("pickup_hour").alias("first_hour"),
        F.max("pickup_hour").alias("last_hour"),
        F.sum("rides").cast("bigint").alias("total_rides"),
    )


def row_counts(df: DataFrame, locations: list[int]) -> DataFrame:
    """Whole-table row count plus the rows of each listed location, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col("pickup_location_id") == loc).alias(f"n_rows_{loc}")
                    for loc in locations])


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null) for every column, from ONE aggregation."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', '{t}', `{c}`" for c, t in df.dtypes)
    return counts.selectExpr(
        f"stack({len(df.columns)}, {stack}) AS (column_name, data_type, non_null)"
    ).withColumn("non_null", F.col("non_null").cast("bigint"))


def first_locations(demand: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` smallest distinct location ids (deterministic LIMIT)."""
    return demand.select("pickup_location_id").distinct().orderBy("pickup_location_id").limit(n)


def demand_by_band(demand: DataFrame) -> DataFrame:
    """Rides and hours per (location, hour band)."""
    return (demand.withColumn("hour_band", hour_band("pickup_hour"))
            .groupBy("pickup_location_id", "hour_band")
            .agg(F.count(F.lit(1)).alias("n_hours"),
                 F.sum("rides").cast("bigint").alias("total_rides")))
