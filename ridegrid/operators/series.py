"""Hourly demand series: count trips per (hour, location), then fill the grid.

The grid of one landing month is (first..last observed hour) x (locations seen
that month).  It is built without any driver round trip: per-month bounds (one
row per month) are joined to per-month distinct locations (at most a few
hundred per month), and only then exploded into hours, so the explosion
happens on a tiny frame and never before a shuffle of raw trips.  Counting uses
partial (map-side) aggregation, so a location holding a third of all trips
costs one row per hour per map task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import floor_hour, hour_sequence
from ..session import reliable_checkpoint
from .clean import KEYS, assign_landing_month, clean_trips, finalize_trips


def _keys(df: DataFrame, keys: list[str] | None) -> list[str]:
    if keys is not None:
        return keys
    return [k for k in KEYS if k in df.columns]


def hourly_rides(trips: DataFrame, keys: list[str] | None = None,
                 time_col: str = "pickup_datetime",
                 loc_col: str = "pickup_location_id") -> DataFrame:
    """``count(*)`` per (keys, hour, location) -> rides (bigint)."""
    keys = _keys(trips, keys)
    return (trips.groupBy(*keys, floor_hour(time_col).alias("pickup_hour"),
                          F.col(loc_col).alias("pickup_location_id"))
            .agg(F.count(F.lit(1)).alias("rides")))


def hour_bounds(series: DataFrame, keys: list[str] | None = None,
                hour_col: str = "pickup_hour") -> DataFrame:
    """First and last hour per key plus the hour count of the span."""
    keys = _keys(series, keys)
    b = series.groupBy(*keys).agg(F.min(hour_col).alias("first_hour"),
                                  F.max(hour_col).alias("last_hour"))
    n = F.timestamp_diff("HOUR", F.col("first_hour"), F.col("last_hour")) + 1
    return b.withColumn("n_hours", n.cast("bigint"))


def distinct_locations(series: DataFrame, keys: list[str] | None = None,
                       loc_col: str = "pickup_location_id") -> DataFrame:
    keys = _keys(series, keys)
    return series.select(*keys, loc_col).distinct()


def hour_location_grid(series: DataFrame, keys: list[str] | None = None,
                       hour_col: str = "pickup_hour",
                       loc_col: str = "pickup_location_id") -> DataFrame:
    """Every (hour, location) of each key's observed span and location set."""
    keys = _keys(series, keys)
    bounds = hour_bounds(series, keys, hour_col).drop("n_hours")
    locs = distinct_locations(series, keys, loc_col)
    if keys:
        # one row per key: small for months, and not forced to be broadcast for finer keys
        cells = locs.join(bounds, keys, "inner")
    else:
        # one global span: attach it as scalar subqueries (evaluated once)
        cells = locs.select(loc_col, bounds.select("first_hour").scalar().alias("first_hour"),
                            bounds.select("last_hour").scalar().alias("last_hour"))
    return cells.select(*keys, F.explode(hour_sequence("first_hour", "last_hour")).alias(hour_col),
                        loc_col)


def fill_missing_hours(series: DataFrame, hour_col: str = "pickup_hour",
                       loc_col: str = "pickup_location_id", value_col: str = "rides",
                       keys: list[str] | None = None) -> DataFrame:
    """Left-join the grid with the observed values; missing cells become 0 (int)."""
    keys = _keys(series, keys)
    grid = hour_location_grid(series, keys, hour_col, loc_col)
    on = [*keys, hour_col, loc_col]
    return (grid.join(series.select(*on, value_col), on, "left")
            .withColumn(value_col, F.coalesce(F.col(value_col), F.lit(0)).cast("int")))


def hourly_demand(trips: DataFrame, keys: list[str] | None = None,
                  materialize: bool = True) -> DataFrame:
    """Cleaned trips -> dense, zero-filled (keys, pickup_hour, location, rides).

    The hourly counts are read three times (bounds, locations, fill join).  They
    are small (hours x locations per month, independent of the trip volume), so
    they are checkpointed to the shared checkpoint folder: the trips are then
    scanned once for counting instead of once per use, and the lineage is cut.
    """
    keys = _keys(trips, keys)
    counts = hourly_rides(trips, keys)
    if materialize:
        counts = reliable_checkpoint(counts)
    return fill_missing_hours(counts, keys=keys).select(
        *keys, "pickup_hour", "pickup_location_id", "rides")


def backfill(raw: DataFrame, months: list[tuple[int, int]] | None = None,
             rel_err: float = 0.01, exact: bool = False) -> DataFrame:
    """Many months in one job, each with its own bounds and its own grid.

    ``raw`` is either a landed lake with ``year``/``month`` partition columns
    (each trip judged against the file it landed in) or a plain trip table,
    which is then keyed by pickup month.  ``months`` restricts the run.
    """
    if all(k in raw.columns for k in KEYS):
        keyed = raw
        if months:
            from functools import reduce
            keyed = keyed.where(reduce(lambda a, b: a | b, [
                (F.col("year") == y) & (F.col("month") == m) for y, m in months]))
    else:
        keyed = assign_landing_month(raw, months)
    clean = finalize_trips(clean_trips(keyed, rel_err=rel_err, exact=exact))
    return hourly_demand(clean, KEYS)
