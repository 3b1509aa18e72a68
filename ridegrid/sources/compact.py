"""Compaction of tiny prediction files into sized Parquet files that keep their folder keys as columns.

The served layout has a CSV file per location-hour; reading it costs a file open per few rows.  Here every
file is opened once: its rows are staged as a table in the shared checkpoint folder, with the name and
size of their file.  The files are laid end to end in the order of month, location, day and hour, and
cut every ``target_bytes``: a bin per cut, a task per bin, a Parquet file per bin and month.  Rows go
to the bin in which their part of the file starts, so a file beyond the target is divided too and a
bin holds at most the target and one split of a file.

Places are summed in two steps, locations within a month and files within a location and month, so no
task orders more than a location's files of a month.  The driver sees a row per month.

A month is replaced as a whole when it is compacted again, other months stay.  Defined cases: folders
whose key is not a number are left out, as by ``read_predictions``; files without rows take no
place; without any row nothing is written.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .lake import MONTH_KEYS, PREDICTION_KEYS, read_predictions

TARGET_BYTES = 128 << 20


def staged_rows(spark: SparkSession, base: str, years: list[int] | None = None, file_glob: str = "prediction.csv",
                with_time: bool = True) -> DataFrame:
    """``read_predictions`` written once, with _path and _bytes of each row's file and _at, where its split starts."""
    rows = read_predictions(spark, base, years, file_glob, with_time)
    meta = {"_path": "file_path", "_bytes": "file_size", "_at": "file_block_start"}
    return reliable_checkpoint(rows.select("*", *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()]),
                               "prediction-rows")


def file_places(staged: DataFrame) -> DataFrame:
    """Every file of ``staged`` once, and _start: the bytes of its month that lie before it."""
    files = staged.groupBy(*PREDICTION_KEYS, "_path").agg(F.max("_bytes").alias("_bytes"))
    own = Window.partitionBy(*MONTH_KEYS, "pickup_location_id").orderBy("day", "hour", "_path")
    within = files.withColumn("_before", F.sum("_bytes").over(own) - F.col("_bytes"))
    sums = files.groupBy(*MONTH_KEYS, "pickup_location_id").agg(F.sum("_bytes").alias("_sum"))
    months = Window.partitionBy(*MONTH_KEYS).orderBy("pickup_location_id")
    firsts = sums.select(*MONTH_KEYS, "pickup_location_id", (F.sum("_sum").over(months) - F.col("_sum")).alias("_first"))
    return within.join(firsts, [*MONTH_KEYS, "pickup_location_id"]).select(
        *PREDICTION_KEYS, "_path", "_bytes", (F.col("_first") + F.col("_before")).alias("_start"))


def compact_predictions(spark: SparkSession, base: str, out: str, years: list[int] | None = None,
                        file_glob: str = "prediction.csv", with_time: bool = True,
                        target_bytes: int = TARGET_BYTES) -> str:
    """Rewrite the prediction files under ``base`` as Parquet under ``out`` (year / month folders)."""
    staged = staged_rows(spark, base, years, file_glob, with_time)
    places = file_places(staged)
    sums = places.groupBy(*MONTH_KEYS).agg(F.sum("_bytes").alias("b")).collect()  # a row per month
    if not sums:
        return out
    first, n = [], 0
    for r in sums:  # bins are numbered through all months
        first.append(F.when((F.col("year") == r["year"]) & (F.col("month") == r["month"]), n))
        n += max(1, -(-r["b"] // target_bytes))
    placed = staged.join(places.select("_path", "_start"), "_path").withColumn(
        "_bin", (F.coalesce(*first) + F.floor((F.col("_start") + F.col("_at")) / target_bytes)).cast("int"))
    dealt = placed.repartitionById(n, "_bin").drop("_path", "_bytes", "_at", "_start", "_bin")
    (dealt.sortWithinPartitions(*MONTH_KEYS, "pickup_location_id", "day", "hour").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH_KEYS).parquet(out))
    return out


def read_compacted(spark: SparkSession, out: str, years: list[int] | None = None) -> DataFrame:
    """The compacted rows, with the columns of ``read_predictions``; year folders are pruned."""
    df = spark.read.parquet(out)
    if years:
        df = df.where(F.col("year").isin(list(years)))
    order = [c for c in df.columns if c not in PREDICTION_KEYS]
    return df.select(*order, *PREDICTION_KEYS)
