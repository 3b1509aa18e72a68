"""What a batch run has already built: file fingerprints per month, and the months that differ since.

A landed month is known by its files' names, sizes and modification times, taken from a listing (no file is
opened) and combined into one number whatever their order.  The manifest keeps the fingerprints of the
last run, a row per month.  A month whose files were replaced, added or removed inside the same
folder is rebuilt; one without change is not touched.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import MONTH_KEYS, drop_stale_months
from .mixed import month_folders

MANIFEST = "year int, month int, files long, bytes long, fingerprint long"


def file_states(spark: SparkSession, base: str) -> DataFrame:
    """(year, month, path, bytes, changed) of every file of every landed month; file contents are not read."""
    if not month_folders(spark, base):
        return spark.createDataFrame([], "year int, month int, path string, bytes long, changed timestamp")
    files = spark.read.format("binaryFile").option("basePath", base).option("pathGlobFilter", "[^_.]*").load(
        f"{base.rstrip('/')}/year=*/month=*")
    keyed = files.select(*[F.col(k).try_cast("int").alias(k) for k in MONTH_KEYS], "path", F.col("length").alias("bytes"),
                         F.col("modificationTime").alias("changed"))
    return keyed.where("year is not null and month is not null")


def month_states(spark: SparkSession, base: str) -> DataFrame:
    """A row per landed month: files, bytes and the fingerprint of its files."""
    name = F.substring_index("path", "/", -1)
    return file_states(spark, base).groupBy(*MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.bit_xor(F.xxhash64(name, "bytes", "changed")).alias("fingerprint"))


def recorded_states(spark: SparkSession, manifest: str) -> DataFrame:
    """The fingerprints of the last run (none before the first)."""
    if not month_folders(spark, manifest):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifest)


def changed_months(now: DataFrame, before: DataFrame) -> DataFrame:
    """(year, month, change): months that are ``added``, ``removed`` or ``replaced`` since."""
    a = now.select(*MONTH_KEYS, F.struct("files", "bytes", "fingerprint").alias("now"))
    b = before.select(*MONTH_KEYS, F.struct("files", "bytes", "fingerprint").alias("before"))
    both = a.join(b, MONTH_KEYS, "full")
    change = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").when(
        F.col("now") != F.col("before"), "replaced")
    return both.select(*MONTH_KEYS, change.alias("change")).where("change is not null")


def record(now: DataFrame, changes: list[tuple[int, int, str]], manifest: str) -> None:
    """Write the fingerprints of the changed months; removed months leave the manifest."""
    spark = now.sparkSession
    kept = [(y, m) for y, m, change in changes if change != "removed"]
    if kept:
        some = now.join(spark.createDataFrame(kept, "year int, month int"), MONTH_KEYS, "left_semi")
        (some.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*MONTH_KEYS).parquet(manifest))
    drop_stale_months(spark, manifest, {(y, m): False for y, m, change in changes if change == "removed"})
