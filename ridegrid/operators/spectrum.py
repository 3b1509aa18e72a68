"""The full spectrum of each location's hourly series, and its strongest periods.

``fourier_features`` measures three periods that are named beforehand; here every frequency that the
length of a series allows is measured, so that unexpected rhythms are found too.

A series of n hours, from a location's first hour to its last, has the frequencies k = 1 .. n // 2
(k cycles over the series, a period of n / k hours).  Its mean is taken off first; hours without a
row, or with a null value, count as the mean.  With x the centred values and t = 0 .. n - 1,
hours since the first hour:
  cos_coef = sum(x * cos(2 pi k t / n)), sin_coef likewise with sin,
  amplitude = 2 / n * sqrt(cos_coef^2 + sin_coef^2), and half of that for k = n / 2.

Rows of one location and hour are summed before they are grouped by location, so what a task holds of
a location is bounded by the calendar (an array of its hours), however many rows it has.  All
frequencies come from two fast cosine transforms per location (Spark ML's ``DCT``), n log n steps; the same
sums as a join of hours with frequencies would make n^2 / 2 rows.  With C and S the two sums of a frequency and
h = pi k / n, the transform of x has at 2k cos(h) C - sin(h) S, and that of x begun one hour later, its first
hour put last, cos(h) C + sin(h) S.  At k = n / 2, where cos(h) is 0, C is the sum with alternating signs.

Defined cases: rows without an hour are left out; a null location is a location of its own; a
location with one hour, or with no value at all, has no frequency and no row; a constant series has
amplitude 0 everywhere and a null share.
"""
from __future__ import annotations

from pyspark.ml.feature import DCT
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds, from_epoch_seconds
from .features import _round4


def spectrum(series: DataFrame, hour_col: str = "pickup_hour", loc_col: str = "pickup_location_id",
             value_col: str = "rides") -> DataFrame:
    """(location, first_hour, n_hours, k, cos_coef, sin_coef) for every frequency of every location, unrounded."""
    hours = series.select(F.col(loc_col).alias("loc"), F.floor(epoch_seconds(hour_col) / 3600).cast("long").alias("t"),
                          F.col(value_col).cast("double").alias("x"))
    hours = hours.where("t is not null").groupBy("loc", "t").agg(F.sum("x").alias("x")).withColumn("x", F.expr("if(isnan(x), null, x)"))
    of_loc = hours.groupBy("loc").agg(
        F.array_sort(F.collect_list(F.struct("t", "x"))).alias("rows"), F.avg("x").alias("mean"),
        F.min("t").alias("t0"), (F.max("t") - F.min("t") + 1).alias("n_hours")).where("n_hours > 1 and mean is not null")
    # an hour's value, and zeros up to the next hour that has a row
    dense = of_loc.select("loc", "t0", "n_hours", F.expr("""flatten(transform(rows, (r, i) -> concat(
        array(coalesce(r.x - mean, 0D)), array_repeat(0D, cast(coalesce(get(rows, i + 1).t - r.t, 1) - 1 as int)))))""").alias("x"))
    signs = F.expr("aggregate(x, struct(0D as s, 1D as f), (a, v) -> struct(a.s + a.f * v as s, -a.f as f)).s")
    later = F.expr("concat(slice(x, 2, size(x) - 1), slice(x, 1, 1))")
    both = dense.select("loc", "t0", "n_hours", signs.alias("last"), array_to_vector("x").alias("x"),
                        array_to_vector(later).alias("later"))
    for c in ("x", "later"):
        both = DCT(inputCol=c, outputCol=f"{c}_dct").transform(both)
    parts = both.select("loc", "t0", "n_hours", "last", vector_to_array("x_dct").alias("d"), vector_to_array("later_dct").alias("e"))
    # of 2k = 2, 4 .. up to n - 1; the transforms are scaled by sqrt(2 / n)
    sums = parts.select("loc", "t0", "n_hours", F.explode(F.expr("""concat(
        transform(filter(sequence(1L, n_hours div 2), k -> 2 * k < n_hours), k -> struct(
            k, (e[2 * k] + d[2 * k]) * sqrt(n_hours / 2) / (2 * cos(pi() * k / n_hours)) as cos_coef,
            (e[2 * k] - d[2 * k]) * sqrt(n_hours / 2) / (2 * sin(pi() * k / n_hours)) as sin_coef)),
        if(n_hours % 2 = 0, array(struct(n_hours div 2 as k, last as cos_coef, 0D as sin_coef)), array()))""")).alias("p"))
    return sums.select(F.col("loc").alias(loc_col), from_epoch_seconds(F.col("t0") * 3600).alias("first_hour"), "n_hours", "p.*")


def amplitudes(spec: DataFrame, loc_col: str = "pickup_location_id") -> DataFrame:
    """A spectrum's amplitudes and periods, figures rounded to four decimals."""
    size = F.sqrt(F.col("cos_coef") ** 2 + F.col("sin_coef") ** 2)
    sides = F.when(F.col("k") * 2 == F.col("n_hours"), 1).otherwise(2)
    return spec.select(loc_col, "first_hour", "n_hours", "k", _round4(F.col("n_hours") / F.col("k")).alias("period_hours"),
                       _round4(F.col("cos_coef")).alias("cos_coef"), _round4(F.col("sin_coef")).alias("sin_coef"),
                       _round4(size * sides / F.col("n_hours")).alias("amplitude"))


def dominant_periods(spec: DataFrame, top: int = 5, loc_col: str = "pickup_location_id") -> DataFrame:
    """The ``top`` strongest frequencies of each location, ties to the longer period.

    ``share``: the part of the location's variance that the frequency carries.  Strengths are compared
    after rounding to six decimals, so that the order does not hang on the order of additions.
    """
    sides = F.when(F.col("k") * 2 == F.col("n_hours"), 1).otherwise(2)
    power = sides * (F.col("cos_coef") ** 2 + F.col("sin_coef") ** 2) / F.col("n_hours") ** 2
    of_loc = Window.partitionBy(loc_col)
    total = F.sum("power").over(of_loc)
    strongest = of_loc.orderBy(F.round("power", 6).desc(), "k")
    ranked = spec.withColumn("power", power).select(
        "*", F.row_number().over(strongest).alias("rank"),
        F.when(F.round(total, 9) > 0, F.round(F.col("power") / total, 4)).alias("share"))
    return ranked.where(F.col("rank") <= top).select(
        loc_col, "rank", "first_hour", "n_hours", "k", _round4(F.col("n_hours") / F.col("k")).alias("period_hours"),
        _round4(F.sqrt(F.col("power") * sides)).alias("amplitude"), "share")
