"""Demand model of a piecewise-linear trend with daily and weekly seasons, fitted for all locations at once.

A location's rides are a sum of terms: a level, a slope, bends (a change of slope at evenly spaced
points of the first part of the history), and cosine / sine pairs of the day and the week.  Least squares with a
small penalty needs only sums of products of terms, so a fit is one grouped aggregation of the series
(combined before the shuffle) and a small linear solve per location, which is a fold over an array
expression: no per-location Python, no driver round trip.

Several cutoffs are fitted in the same pass.  A row's products count for every cutoff after its hour; they are
summed once per location and stretch between two cutoffs, and a running sum over the cutoffs (their
number times the locations) gives each fit its own sums.  The series is not read again for a further cutoff.

A fit uses hours before its cutoff only.  Time runs from 0 at the first hour of the series to 1 at the last
cutoff, and bends that a fit has not reached stay 0 by the penalty.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds
from .metrics import metric_columns

LOC, HOUR, VALUE = "pickup_location_id", "pickup_hour", "rides"


@dataclass(frozen=True)
class TrendModel:
    """Bends in the first ``bend_share`` of the history; (period in hours, harmonics); penalties."""

    bends: int = 3
    bend_share: float = 0.8
    seasons: tuple[tuple[int, int], ...] = ((24, 2), (168, 2))
    penalty: float = 1e-3
    bend_penalty: float = 1.0

    @property
    def bend_points(self) -> list[float]:
        return [self.bend_share * (j + 1) / (self.bends + 1) for j in range(self.bends)]

    @property
    def terms(self) -> list[str]:
        names = ["level", "slope"] + [f"bend_{j + 1}" for j in range(self.bends)]
        return names + [f"{f}_{p}_{k}" for p, n in self.seasons for k in range(1, n + 1) for f in ("cos", "sin")]

    def columns(self, u: Column, hour: Column) -> list[Column]:
        """The terms of a row from its scaled time and its absolute hour number."""
        out = [F.lit(1.0), u] + [F.greatest(F.lit(0.0), u - s) for s in self.bend_points]
        for p, n in self.seasons:
            for k in range(1, n + 1):
                angle = F.lit(2 * math.pi) * (hour * k % p) / p  # reduced first: small and exact
                out += [F.cos(angle), F.sin(angle)]
        return out

    @property
    def penalties(self) -> list[float]:
        return [self.bend_penalty if t.startswith("bend_") else self.penalty for t in self.terms]


def cutoffs(spark: SparkSession, first, every_hours: int, n: int) -> DataFrame:
    """``n`` cutoffs from ``first`` on, ``every_hours`` apart."""
    start = F.lit(first).cast("timestamp_ntz")
    return spark.range(n).select(F.timestamp_add("HOUR", (F.col("id") * every_hours).cast("int"), start).alias("cutoff"))


def _hour(c: Column | str) -> Column:
    return F.floor(epoch_seconds(c) / 3600).cast("bigint")


def with_terms(rows: DataFrame, series: DataFrame, ends: DataFrame, model: TrendModel, name: str = "terms") -> DataFrame:
    """``rows`` with the array of their terms; scaled by the first hour of ``series`` and the last of the cutoffs."""
    first = series.agg(F.min(HOUR).alias("h")).select(_hour(F.col("h"))).scalar()
    last = ends.agg(F.max("cutoff").alias("h")).select(_hour(F.col("h"))).scalar()
    u = (_hour(HOUR) - first) / F.greatest(F.lit(1), last - first)
    return rows.withColumn(name, F.array(*[c.cast("double") for c in model.columns(u, _hour(HOUR))]))


def _solved(p: int) -> str:
    """The equations ``m`` (p rows of p + 1 numbers) with all off-diagonal coefficients removed.

    The matrix is positive definite (penalties), so pivots are taken in order.
    """
    return (f"aggregate(sequence(0, {p - 1}), m, (m, i) -> transform(m, (r, j) -> if(j = i, transform(r, v -> v / r[i]), "
            "zip_with(r, m[i], (a, b) -> a - r[i] / m[i][i] * b))))")


def fit(series: DataFrame, ends: DataFrame, model: TrendModel = TrendModel()) -> DataFrame:
    """(location, cutoff, coefs) for every location of the series and every cutoff that has a row before it."""
    p = len(model.terms)
    points = ends.agg(F.array_sort(F.collect_set("cutoff")).alias("c"))  # one row: the cutoffs
    at = F.size(F.filter(F.col("c"), lambda c: c <= F.col(HOUR)))  # the cutoffs at or before the hour
    rows = with_terms(series.where(F.col(VALUE).isNotNull()), series, ends, model)
    rows = rows.withColumn("c", points.scalar()).withColumn("seg", at).where(F.col("seg") < F.size("c"))
    x = [F.col("terms")[i] for i in range(p)]
    y = F.col(VALUE).cast("double")
    pairs = [(i, j) for i in range(p) for j in range(i, p + 1)]
    parts = rows.groupBy(LOC, "seg").agg(*[F.sum(x[i] * (y if j == p else x[j])).alias(f"s_{i}_{j}") for i, j in pairs],
                                         F.count(F.lit(1)).alias("n"))
    # every cutoff of every location, with the running sums of the stretches before it
    grid = parts.select(LOC).distinct().select(LOC, F.posexplode(points.scalar()).alias("seg", "cutoff"))
    before = Window.partitionBy(LOC).orderBy("seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [f"s_{i}_{j}" for i, j in pairs] + ["n"]
    run = grid.join(parts, [LOC, "seg"], "left").select(
        LOC, "cutoff", *[F.sum(F.coalesce(F.col(s), F.lit(0))).over(before).alias(s) for s in sums]).where("n > 0")

    def cell(i: int, j: int) -> Column:
        v = F.col(f"s_{min(i, j)}_{max(i, j)}")
        return v + model.penalties[i] if i == j else v

    m = F.array(*[F.array(*[cell(i, j) for j in range(p + 1)]) for i in range(p)])
    solved = run.select(LOC, "cutoff", m.alias("m")).select(LOC, "cutoff", F.expr(_solved(p)).alias("m"))
    return solved.select(LOC, "cutoff", F.transform("m", lambda r: r[p]).alias("coefs"))


def coefficients(fitted: DataFrame, model: TrendModel = TrendModel()) -> DataFrame:
    """A row per location, cutoff and term."""
    names = F.array(*[F.lit(t) for t in model.terms])
    return fitted.select(LOC, "cutoff", F.explode(F.arrays_zip(names.alias("term"), F.col("coefs").alias("coef"))).alias("t")) \
        .select(LOC, "cutoff", "t.term", "t.coef")


def _value() -> Column:
    return F.aggregate(F.zip_with("terms", "coefs", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def predicted(rows: DataFrame, fitted: DataFrame, series: DataFrame, ends: DataFrame, model: TrendModel = TrendModel()) -> DataFrame:
    """``rows`` (location, hour, cutoff) with the model's ``estimate`` and ``predicted_rides``, whole and never negative."""
    known = with_terms(rows, series, ends, model).join(fitted, [LOC, "cutoff"]).withColumn("estimate", _value())
    return known.withColumn("predicted_rides", F.greatest(F.lit(0), F.round("estimate")).cast("int")).drop("terms", "coefs")


def trend_forecast(series: DataFrame, split_at, model: TrendModel = TrendModel()) -> DataFrame:
    """Predictions for hours from ``split_at`` on, from hours before it: the served prediction columns, and ``estimate``."""
    split = F.lit(split_at).cast("timestamp_ntz")
    ends = series.sparkSession.range(1).select(split.alias("cutoff"))
    rows = series.where(F.col(HOUR) >= split).select(LOC, HOUR).withColumn("cutoff", split)
    return predicted(rows, fit(series, ends, model), series, ends, model).select(
        F.col(LOC).cast("int").alias(LOC), F.col(HOUR).alias("prediction_datetime"), "predicted_rides", "estimate")


# ------------------------------------------------------------ rolling origins
def horizons(series: DataFrame, ends: DataFrame, hours: int) -> DataFrame:
    """Every row of the series once for each cutoff within ``hours`` before it: cutoff, ``horizon`` (1: the first hour).

    The range condition is joined by stretches of that length: a cutoff reaches into its own stretch and the
    next one, an hour lies in one, so the join is on the stretch and no pair further apart is made.
    """
    stretch = F.floor(_hour(HOUR) / hours)
    c = _hour("cutoff")
    reach = ends.select("cutoff", F.explode(F.array(F.floor(c / hours), F.floor(c / hours) + 1)).alias("stretch"))
    rows = series.withColumn("stretch", stretch).join(reach, "stretch").drop("stretch")
    ahead = _hour(HOUR) - _hour("cutoff")
    return rows.withColumn("horizon", (ahead + 1).cast("int")).where((ahead >= 0) & (ahead < hours))


def seasonal_naive(rows: DataFrame, series: DataFrame, period: int = 168) -> DataFrame:
    """Rows of ``horizons`` with the last value known at the cutoff for the same hour of the period."""
    back = (F.floor((F.col("horizon") - 1) / period) + 1) * period
    known = series.where(F.col(VALUE).isNotNull()).groupBy(LOC, _hour(HOUR).alias("_at")).agg(
        F.max(VALUE).alias("predicted_rides"))
    return rows.withColumn("_at", (_hour(HOUR) - back).cast("bigint")).join(known, [LOC, "_at"]).drop("_at")


def rolling_trend(series: DataFrame, ends: DataFrame, hours: int, model: TrendModel = TrendModel()) -> DataFrame:
    """Rows of ``horizons`` with the trend model's prediction, each from the hours before its own cutoff."""
    return predicted(horizons(series, ends, hours), fit(series, ends, model), series, ends, model)


def errors_by_horizon(pairs: DataFrame, unit_hours: int = 24) -> DataFrame:
    """MAE, MAPE and pairs by the horizon in units of ``unit_hours`` (1: the first unit after the cutoff)."""
    unit = F.floor((F.col("horizon") - 1) / unit_hours + 1).cast("int")
    return pairs.groupBy(unit.alias("horizon_unit")).agg(*metric_columns())
