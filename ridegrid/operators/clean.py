"""Cleaning of raw trip records: null, month, range and zone filters.

Every trip is judged against its *landing month* (the ``year`` / ``month`` of
the monthly file it arrived in).  A single-month run attaches the month as
literals, so the time range is pushed into the Parquet scan; a multi-month run
(``backfill``) carries the landing keys as partition columns and every month
gets its own quantile bounds.  Bounds stay a small keyed DataFrame joined back
by broadcast (one row per month), so nothing is collected to the driver.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds, month_start, next_month_start
from ..schemas import (EXCLUDED_LOCATIONS, MAX_PASSENGERS, MIN_PASSENGERS, MIN_TOTAL_AMOUNT,
                       QUANTILE_REL_ERR, RAW_DO, RAW_DROPOFF, RAW_PICKUP, RAW_PU,
                       REQUIRED_COLUMNS, UPPER_QUANTILE)
from .quantiles import exact_quantiles

KEYS = ["year", "month"]
# Column -> name of its upper bound.
BOUNDED = {"duration": "max_duration", "total_amount": "max_total_amount",
           "trip_distance": "max_distance"}
# Stage names of the drop waterfall, in the order the filters apply.
STAGES = ["missing", "date_range", "duration", "total_amount", "distance", "location",
          "passenger_count"]


# --------------------------------------------------------------------- keys
def with_landing_month(df: DataFrame, year: int | None = None,
                       month: int | None = None) -> DataFrame:
    """Attach or select the landing month.

    * ``year``/``month`` given and the frame has partition columns: prune to it.
    * given, no partition columns: the whole frame is that month's file.
    * not given: the frame must carry ``year``/``month`` (a partitioned lake).
    """
    has_keys = all(k in df.columns for k in KEYS)
    if year is None or month is None:
        if not has_keys:
            raise ValueError("multi-month input needs year/month columns; "
                             "use assign_landing_month() or pass year and month")
        return df
    if has_keys:
        return df.where((F.col("year") == year) & (F.col("month") == month))
    return df.withColumn("year", F.lit(year)).withColumn("month", F.lit(month))


def assign_landing_month(df: DataFrame, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Key an unpartitioned trip table by the calendar month of its pickup time."""
    keyed = (df.withColumn("year", F.year(RAW_PICKUP))
             .withColumn("month", F.month(RAW_PICKUP)))
    if months:
        cond = reduce(lambda a, b: a | b,
                      [(F.col("year") == y) & (F.col("month") == m) for y, m in months])
        keyed = keyed.where(cond)
    return keyed


# --------------------------------------------------------------- predicates
def not_null_condition(cols: list[str] = REQUIRED_COLUMNS) -> Column:
    """All listed columns are non-null (NaN is *not* null and is kept)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def in_month(c: Column | str, year: Column | int | str = "year",
             month: Column | int | str = "month") -> Column:
    """Half-open ``[first of month, first of next month)``; December rolls over."""
    c = F.col(c) if isinstance(c, str) else c
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return (c >= month_start(y, m)) & (c < next_month_start(y, m))


def _at_most(c: str, bound: str, inert: bool) -> Column:
    if inert:
        # The bound is the maximum of the non-NaN values of the very rows being
        # filtered, so ``c <= bound`` holds exactly for the non-NaN rows.
        return ~F.isnan(F.col(c).cast("double"))
    return F.col(c) <= F.col(bound)


def duration_ok(inert: bool = False) -> Column:
    return (F.col("duration") > 0) & _at_most("duration", "max_duration", inert)


def amount_ok(inert: bool = False) -> Column:
    return ((F.col("total_amount") >= MIN_TOTAL_AMOUNT)
            & _at_most("total_amount", "max_total_amount", inert))


def distance_ok(inert: bool = False) -> Column:
    return (F.col("trip_distance") > 0) & _at_most("trip_distance", "max_distance", inert)


def bounds_are_inert(p: float = UPPER_QUANTILE, rel_err: float = QUANTILE_REL_ERR,
                     exact: bool = False) -> bool:
    """True when the quantile sketch would return the maximum (p >= 1 - rel_err).

    Then every upper bound equals the largest non-NaN value of the rows it
    filters and the bound filters keep exactly the non-NaN rows: no bounds
    pass is needed.  This is the original job's setting (p=0.999, rel_err=0.01).
    """
    if exact or rel_err == 0:
        return p >= 1.0
    accuracy = max(1, int(round(1.0 / rel_err)))
    return p >= 1.0 - 1.0 / accuracy


def location_ok() -> Column:
    return ~F.col(RAW_PU).isin(EXCLUDED_LOCATIONS)


def passengers_ok() -> Column:
    return F.col("passenger_count").between(MIN_PASSENGERS, MAX_PASSENGERS)


# ---------------------------------------------------------------- operators
def filter_not_null(df: DataFrame) -> DataFrame:
    return df.where(not_null_condition())


def filter_in_month(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    if year is not None and month is not None:
        # Literal bounds: constant-folded and pushed into the Parquet scan.
        return df.where(in_month(RAW_PICKUP, F.lit(year), F.lit(month)))
    return df.where(in_month(RAW_PICKUP))


def with_duration(df: DataFrame) -> DataFrame:
    """Trip duration in whole seconds (difference of two epoch-second values)."""
    return df.withColumn("duration", epoch_seconds(RAW_DROPOFF) - epoch_seconds(RAW_PICKUP))


def _finite(c: str) -> Column:
    return F.when(~F.isnan(F.col(c)), F.col(c))


def upper_bounds(df: DataFrame, p: float = UPPER_QUANTILE, rel_err: float = QUANTILE_REL_ERR,
                 keys: list[str] = KEYS) -> DataFrame:
    """Approximate p-quantile of duration, amount and distance per landing month.

    One grouped aggregation with a fixed-size quantile sketch per month (partial
    aggregation merges sketches, so a hot month never lands in one task).  At
    the parity setting (p=0.999, rel_err=0.01) the sketch returns the largest
    value, so the bounds drop only NaN rows; this mirrors the original job.
    """
    if rel_err == 0:
        return upper_bounds_exact(df, p=p, keys=keys)
    accuracy = max(1, int(round(1.0 / rel_err)))
    if p >= 1.0 - 1.0 / accuracy:
        # The sketch answers any p >= 1 - rel_err with its last sample, which is
        # always the exact maximum: a plain max gives the identical bound for a
        # fraction of the per-row cost.
        aggs = [F.max(_finite(c).cast("double")).alias(b) for c, b in BOUNDED.items()]
    elif p <= 1.0 / accuracy:
        aggs = [F.min(_finite(c).cast("double")).alias(b) for c, b in BOUNDED.items()]
    else:
        aggs = [F.percentile_approx(_finite(c).cast("double"), F.lit(p), F.lit(accuracy)).alias(b)
                for c, b in BOUNDED.items()]
    return df.groupBy(*keys).agg(*aggs)


def exact_quantile(df: DataFrame, value: Column | str, p: float, keys: list[str],
                   name: str = "quantile") -> DataFrame:
    """Exact p-quantile per key group (linear interpolation, as ``percentile``), by bracketing its ranks."""
    return exact_quantiles(df, {name: value}, p, keys).where(F.col(name).isNotNull())


def upper_bounds_exact(df: DataFrame, p: float = UPPER_QUANTILE,
                       keys: list[str] = KEYS) -> DataFrame:
    """Exact p-quantile of duration, amount and distance per landing month.

    The three measures are bracketed side by side (``quantiles.exact_quantiles``): no shuffle carries the trips.
    """
    return exact_quantiles(df, {b: c for c, b in BOUNDED.items()}, p, keys)


def _prepared(df: DataFrame, year: int | None, month: int | None) -> DataFrame:
    """Landing keys attached, null and month filters applied, duration added."""
    keyed = with_landing_month(df, year, month)
    return with_duration(filter_in_month(filter_not_null(keyed), year, month))


def _bounds(prepared: DataFrame, rel_err: float, exact: bool,
            p: float = UPPER_QUANTILE) -> DataFrame:
    if exact:
        return upper_bounds_exact(prepared, p=p)
    return upper_bounds(prepared, p=p, rel_err=rel_err)


def month_bounds(df: DataFrame, year: int | None = None, month: int | None = None,
                 rel_err: float = QUANTILE_REL_ERR, exact: bool = False,
                 p: float = UPPER_QUANTILE) -> DataFrame:
    """Upper bounds per landing month, from the rows passing the null and month filters.

    Pass it to ``clean_trips`` / ``clean_stats`` / ``tag_stages`` (``bounds=``) to
    compute it once for several outputs (checkpoint it: one row per month).
    """
    return _bounds(_prepared(df, year, month), rel_err, exact, p)


def _all_ok(inert: bool = False) -> Column:
    return (duration_ok(inert) & amount_ok(inert) & distance_ok(inert) & location_ok()
            & passengers_ok())


def clean_trips(df: DataFrame, year: int | None = None, month: int | None = None,
                rel_err: float = QUANTILE_REL_ERR, exact: bool = False,
                bounds: DataFrame | None = None, p: float = UPPER_QUANTILE) -> DataFrame:
    """All filters of the monthly job; keeps raw columns plus ``duration`` and keys.

    Quantile bounds are computed once, on the rows that pass the null and month
    filters, before any range filter (as in the original job).  The bounds frame
    has one row per landing month, so broadcasting it is size-safe.  At a setting
    where the bounds are provably the maximum (``bounds_are_inert``) the filters
    reduce to NaN checks and the trips are read once, with no bounds pass.
    """
    prepared = _prepared(df, year, month)
    if bounds is None and bounds_are_inert(p, rel_err, exact):
        # same column order as the join below (keys first)
        return prepared.where(_all_ok(inert=True)).select(
            *KEYS, *[c for c in prepared.columns if c not in KEYS])
    if bounds is None:
        bounds = _bounds(prepared, rel_err, exact, p)
    return (prepared.join(F.broadcast(bounds), KEYS, "inner")
            .where(_all_ok())
            .drop(*BOUNDED.values()))


def finalize_trips(df: DataFrame, keep_keys: bool = True) -> DataFrame:
    """Rename to the cleaned-table names and cast to the 9 typed columns."""
    cols = [
        F.col(RAW_PICKUP).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(RAW_DROPOFF).cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col(RAW_PU).cast("int").alias("pickup_location_id"),
        F.col(RAW_DO).cast("int").alias("dropoff_location_id"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("payment_type").cast("int").alias("payment_type"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
    ]
    if keep_keys and all(k in df.columns for k in KEYS):
        cols += [F.col(k) for k in KEYS]
    return df.select(*cols)


def _first_failed_stage(inert: bool = False) -> Column:
    """Name of the first filter a row fails; null filter results count as failure."""
    def fails(cond: Column) -> Column:
        return ~F.coalesce(cond, F.lit(False))
    return (F.when(fails(not_null_condition()), F.lit("missing"))
            .when(fails(in_month(RAW_PICKUP)), F.lit("date_range"))
            .when(fails(duration_ok(inert)), F.lit("duration"))
            .when(fails(amount_ok(inert)), F.lit("total_amount"))
            .when(fails(distance_ok(inert)), F.lit("distance"))
            .when(fails(location_ok()), F.lit("location"))
            .when(fails(passengers_ok()), F.lit("passenger_count")))


def tag_stages(df: DataFrame, year: int | None = None, month: int | None = None,
               rel_err: float = QUANTILE_REL_ERR, exact: bool = False,
               bounds: DataFrame | None = None, p: float = UPPER_QUANTILE) -> DataFrame:
    """Every row with ``duration`` and ``stage``: the first filter it fails (null = kept)."""
    keyed = with_landing_month(df, year, month)
    if bounds is None and bounds_are_inert(p, rel_err, exact):
        tagged = with_duration(keyed).withColumn("stage", _first_failed_stage(inert=True))
        return tagged.select(*KEYS, *[c for c in tagged.columns if c not in KEYS])
    if bounds is None:
        bounds = _bounds(_prepared(df, year, month), rel_err, exact, p)
    return (with_duration(keyed).join(F.broadcast(bounds), KEYS, "left")
            .withColumn("stage", _first_failed_stage())
            .drop(*BOUNDED.values()))


def stage_counts():
    """Aggregates of the waterfall over tagged rows (usable in ``agg`` or ``observe``)."""
    aggs = [F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("stage").isNull()).alias("valid_records")]
    return aggs + [F.count_if(F.col("stage") == s).alias(f"dropped_{s}") for s in STAGES]


def clean_stats(df: DataFrame, year: int | None = None, month: int | None = None,
                rel_err: float = QUANTILE_REL_ERR, exact: bool = False,
                bounds: DataFrame | None = None, p: float = UPPER_QUANTILE) -> DataFrame:
    """Drop waterfall per landing month in one pass (plus the quantile pass).

    Each row is tagged with the first stage it fails, then one aggregation
    counts the tags.  Columns: total_records, valid_records, records_dropped,
    percent_dropped (2 decimals, null for an empty month) and one
    ``dropped_<stage>`` column per stage.
    """
    tagged = tag_stages(df, year, month, rel_err, exact, bounds, p).select(*KEYS, "stage")
    single = year is not None and month is not None
    stats = tagged.agg(*stage_counts()) if single else tagged.groupBy(*KEYS).agg(*stage_counts())
    return finish_stats(stats, year, month)


def finish_stats(stats: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Add records_dropped / percent_dropped to stage counts and order the columns."""
    single = year is not None and month is not None
    dropped = F.col("total_records") - F.col("valid_records")
    stats = stats.withColumn("records_dropped", dropped).withColumn(
        "percent_dropped",
        F.when(F.col("total_records") > 0,
               F.round(dropped.cast("double") * 100 / F.col("total_records"), 2)))
    if single:
        stats = stats.select(F.lit(year).alias("year"), F.lit(month).alias("month"), "*")
    return stats.select(*KEYS, "total_records", "valid_records", "records_dropped",
                        "percent_dropped", *[f"dropped_{s}" for s in STAGES])


# Wording of the per-run drop report, one line per figure.
REPORT_LINES = [
    ("Total records: ", "total_records"),
    ("Valid records: ", "valid_records"),
    ("Records dropped: ", "records_dropped"),
    ("Records dropped due to missing values: ", "dropped_missing"),
    ("Records dropped by date range filter: ", "dropped_date_range"),
    ("Records dropped by duration filter: ", "dropped_duration"),
    ("Records dropped by total amount filter: ", "dropped_total_amount"),
    ("Records dropped by distance filter: ", "dropped_distance"),
    ("Records dropped by NYC location filter: ", "dropped_location"),
    ("Records dropped by passenger count filter: ", "dropped_passenger_count"),
]


def stats_report(stats: DataFrame) -> DataFrame:
    """The drop statistics as text lines with thousands separators (year, month, line_no, line).

    The percentage follows the dropped count as ``(12.34%)``; formatting runs in
    Spark (``format_number``), one small row per month in, ten rows out.
    """
    lines = []
    for i, (label, col) in enumerate(REPORT_LINES, start=1):
        text = F.concat(F.lit(label), F.format_number(F.col(col), 0))
        if col == "records_dropped":
            text = F.concat(text, F.lit(" ("), F.format_number(F.col("percent_dropped"), 2),
                            F.lit("%)"))
        lines.append(F.struct(F.lit(i).alias("line_no"), text.alias("line")))
    return (stats.select(*KEYS, F.explode(F.array(*lines)).alias("l"))
            .select(*KEYS, "l.line_no", "l.line"))
