"""The monthly job and its many-month form, as Spark jobs over the lake.

Per month: quantile bounds (one row per month, written once) -> tag each row
with the first filter it fails, count the tags with an ``Observation`` while the
kept rows are written to the cleaned layer (the drop waterfall costs no extra
pass).  At the original setting the bounds are provably the maximum and reduce
to NaN checks, so the raw month is read exactly once -> read the cleaned layer back (lineage
cut, two columns) -> hourly counts (checkpointed, small) -> gap-filled grid ->
write the demand layer.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (KEYS, STAGES, bounds_are_inert, finalize_trips, finish_stats,
                               month_bounds, stage_counts, tag_stages)
from ..operators.series import hourly_demand
from ..schemas import RAW_TYPES
from ..session import reliable_checkpoint
from ..sources.lake import drop_stale_months, read_trips, write_clean_trips, write_demand
from ..sources.manifest import changed_months, month_states, record, recorded_states
from ..sources.mixed import read_months

STATS_SCHEMA = ("year int, month int, total_records bigint, valid_records bigint, "
                + ", ".join(f"dropped_{s} bigint" for s in STAGES))


def _months_filter(months: list[tuple[int, int]]):
    cond = None
    for y, m in months:
        c = (F.col("year") == y) & (F.col("month") == m)
        cond = c if cond is None else cond | c
    return cond


def job_columns(raw: DataFrame) -> DataFrame:
    """Raw trips whose columns that the job compares are numbers and times.

    A column that some month holds as text is text in all of them (``mixed``); here such a column gets its
    declared type, and text that is none of it is a missing value.
    """
    text = [f.name for f in raw.schema.fields if f.dataType.simpleString() == "string" and f.name in RAW_TYPES]
    return raw.withColumns({c: F.col(c).try_cast(RAW_TYPES[c]) for c in text}) if text else raw


def _write_stats(stats: DataFrame, stats_base: str | None) -> None:
    if stats_base:
        (stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*KEYS).parquet(stats_base))


def run_month(spark: SparkSession, raw_base: str, clean_base: str, demand_base: str,
              year: int, month: int, rel_err: float = 0.01,
              stats_base: str | None = None) -> DataFrame:
    """Clean one landed month and write both layers; returns the drop statistics."""
    raw = job_columns(read_trips(spark, raw_base, year, month))
    bounds = None if bounds_are_inert(rel_err=rel_err) else \
        reliable_checkpoint(month_bounds(raw, year, month, rel_err=rel_err))
    observation = Observation(f"drop_waterfall_{year}_{month:02d}")
    tagged = tag_stages(raw, year, month, rel_err=rel_err, bounds=bounds).observe(
        observation, *stage_counts())
    kept = finalize_trips(tagged.where(F.col("stage").isNull()))
    write_clean_trips(kept, clean_base)
    counts = observation.get  # filled by the write above: no extra pass over raw
    row = {"year": year, "month": month, **{k: int(v) for k, v in counts.items()}}
    stats = finish_stats(spark.createDataFrame([row], STATS_SCHEMA).drop(*KEYS), year, month)
    _write_stats(stats, stats_base)
    written = {(year, month): row["valid_records"] > 0}
    drop_stale_months(spark, clean_base, written)
    cleaned = (spark.read.schema(kept.schema).parquet(clean_base)
               .where((F.col("year") == year) & (F.col("month") == month)))
    write_demand(hourly_demand(cleaned, KEYS), demand_base)
    drop_stale_months(spark, demand_base, written)
    return stats


def run_backfill(spark: SparkSession, raw_base: str, clean_base: str, demand_base: str,
                 months: list[tuple[int, int]] | None = None, rel_err: float = 0.01,
                 stats_base: str | None = None) -> DataFrame:
    """All (or the listed) landed months in one job, each with its own bounds and grid.

    Months may have been written with different physical types (``sources.mixed``).
    Rows are tagged with the first filter they fail and counted per month and
    outcome by one grouped pass over the tagged columns, whose cost does not
    grow with the number of months; a second pass writes the kept rows.  Rows
    that landed without a month are counted under a null month.  The run owns
    the months it was asked for (all landed ones by default): a month left
    without rows loses its old output.  Bounds, when not inert, are computed
    once for all months (one row per month).
    """
    raw = job_columns(read_months(spark, raw_base, months or None))
    if months:
        raw = raw.where(_months_filter(months))
    bounds = None if bounds_are_inert(rel_err=rel_err) else \
        reliable_checkpoint(month_bounds(raw, rel_err=rel_err))
    tagged = tag_stages(raw, rel_err=rel_err, bounds=bounds)
    counted = tagged.groupBy(*KEYS, "stage").count()

    def records(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0)).cast("long")

    counts = counted.groupBy(*KEYS).agg(
        records(F.lit(True)).alias("total_records"), records(F.col("stage").isNull()).alias("valid_records"),
        *[records(F.col("stage") == st).alias(f"dropped_{st}") for st in STAGES])
    if months:  # a month asked for and not landed has a row of zeros
        asked = spark.createDataFrame(sorted(set(months)), "year int, month int")
        counts = asked.join(counts, list(KEYS), "left").na.fill(0)
    counts = reliable_checkpoint(counts.select(*[F.col(n).cast(t) for n, t in map(str.split, STATS_SCHEMA.split(", "))]),
                                 "backfill-counts")
    kept = finalize_trips(tagged.where(F.col("stage").isNull()))
    write_clean_trips(kept, clean_base)
    stats = finish_stats(counts)
    _write_stats(stats, stats_base)
    written = {(r["year"], r["month"]): r["valid_records"] > 0 for r in counts.collect()  # a row per month
               if r["year"] is not None and r["month"] is not None}
    drop_stale_months(spark, clean_base, written)
    cleaned = spark.read.schema(kept.schema).parquet(clean_base)
    if months:
        cleaned = cleaned.where(_months_filter(months))
    write_demand(hourly_demand(cleaned, KEYS), demand_base)
    drop_stale_months(spark, demand_base, written)
    return stats


def run_changed(spark: SparkSession, raw_base: str, clean_base: str, demand_base: str, manifest: str,
                rel_err: float = 0.01, stats_base: str | None = None) -> list[tuple[int, int, str]]:
    """Rebuild the months whose landed files differ from those of the last run; returns (year, month, change).

    Fingerprints are taken before the build and recorded after it, so a file that lands meanwhile, or a run that
    fails, makes the month due again.  A removed month loses its output.
    """
    now = reliable_checkpoint(month_states(spark, raw_base), "month-states")
    found = changed_months(now, recorded_states(spark, manifest)).orderBy(*KEYS).collect()  # a row per changed month
    changes = [(r["year"], r["month"], r["change"]) for r in found]
    gone = {(y, m): False for y, m, change in changes if change == "removed"}
    due = [(y, m) for y, m, change in changes if change != "removed"]
    if due:
        run_backfill(spark, raw_base, clean_base, demand_base, months=due, rel_err=rel_err, stats_base=stats_base)
    for base in (clean_base, demand_base, *([stats_base] if stats_base else [])):
        drop_stale_months(spark, base, gone)
    record(now, changes, manifest)
    return changes
