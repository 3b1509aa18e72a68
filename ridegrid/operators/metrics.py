"""Actual-vs-predicted pairing and forecast error metrics (MAE, MAPE).

Both inputs are hour x location series (size independent of trip volume).
The pairing is an equi-join on (location, hour); metrics are plain grouped
averages, partially aggregated before the shuffle, so a location holding a
third of all rows is still one small partial row per map task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LOCATION_NAMES


def locations_frame(spark) -> DataFrame:
    """The fixed dashboard location lookup as a 3-row frame."""
    rows = sorted(LOCATION_NAMES.items())
    return spark.createDataFrame(rows, "pickup_location_id int, location_name string")


def with_location_names(df: DataFrame, loc_col: str = "pickup_location_id") -> DataFrame:
    """Left-join the location name; the lookup has a fixed size, so broadcast it."""
    names = locations_frame(df.sparkSession).withColumnRenamed("pickup_location_id", loc_col)
    return df.join(F.broadcast(names), loc_col, "left")


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame,
                        location: int | None = None) -> DataFrame:
    """Inner join of actual rides and predictions on location and hour.

    ``actual``: pickup_location_id, pickup_hour, rides.
    ``predicted``: pickup_location_id, prediction_datetime, predicted_rides.
    Null hours never match (plain equality).
    """
    a = actual.select("pickup_location_id", "pickup_hour", "rides")
    p = predicted.select("pickup_location_id", F.col("prediction_datetime").alias("pickup_hour"),
                         "predicted_rides")
    if location is not None:
        a = a.where(F.col("pickup_location_id") == location)
        p = p.where(F.col("pickup_location_id") == location)
    return a.join(p, ["pickup_location_id", "pickup_hour"], "inner")


def metric_columns(actual: str = "rides", predicted: str = "predicted_rides"):
    """MAE over all pairs; MAPE (percent) over pairs with a positive actual.

    Both are null when there is no pair; MAPE is null when no actual is positive.
    """
    err = F.abs(F.col(actual) - F.col(predicted))
    mae = F.avg(err.cast("double")).alias("mae")
    mape = (F.avg(F.when(F.col(actual) > 0, err / F.col(actual))) * 100).alias("mape")
    return [mae, mape, F.count(F.lit(1)).alias("n_pairs")]


def forecast_metrics(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row overall (``by`` empty) or one row per ``by`` group."""
    if by:
        return pairs.groupBy(*by).agg(*metric_columns())
    return pairs.agg(*metric_columns())


def compare(actual: DataFrame, predicted: DataFrame, location: int | None = None) -> DataFrame:
    """Merged series ready to plot, with the location name."""
    return with_location_names(actual_vs_predicted(actual, predicted, location))


# ------------------------------------------------------------ sums that merge and can be withdrawn
SUMS = ("n_pairs", "abs_error", "n_positive", "relative_error")


def metric_sums(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The sums behind MAE and MAPE per group (a month, a month and location, ...).

    Relative errors are summed as decimals, so that adding a group's sums and taking them away again leaves
    nothing behind.
    """
    err = F.abs(F.col("rides") - F.col("predicted_rides"))
    share = F.when(F.col("rides") > 0, (err / F.col("rides")).cast("decimal(24,12)"))
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum(err.cast("long")).alias("abs_error"), F.count(share).alias("n_positive"),
        F.coalesce(F.sum(share), F.lit(0)).cast("decimal(38,12)").alias("relative_error"))


def merged_sums(parts: list[tuple[DataFrame, int]], by: list[str]) -> DataFrame:
    """Sums of all parts, each added (1) or withdrawn (-1), per group of ``by``; groups without pairs vanish."""
    signed = None
    for part, sign in parts:
        one = part.select(*by, *[(F.col(c) * sign).alias(c) for c in SUMS])
        signed = one if signed is None else signed.unionByName(one)
    out = signed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])
    return out.select(*by, *[F.col(c).cast("decimal(38,12)" if c == "relative_error" else "long").alias(c) for c in SUMS]).where(
        "n_pairs <> 0")


def metrics_of_sums(sums: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MAE, MAPE and pairs from stored sums, merged over all groups but ``by``."""
    total = {c: F.sum(c) for c in SUMS}
    return sums.groupBy(*(by or [])).agg(
        (total["abs_error"] / total["n_pairs"]).alias("mae"),
        F.when(total["n_positive"] > 0, total["relative_error"].cast("double") / total["n_positive"] * 100).alias("mape"),
        F.coalesce(total["n_pairs"], F.lit(0)).alias("n_pairs"))
