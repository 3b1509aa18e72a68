"""Partitioned lake layout: scans with partition pruning, idempotent sinks.

Layout (Hive-style, discovered by Spark):
  raw / cleaned / demand : <base>/year=YYYY/month=M/part-*.parquet
  predictions            : <base>/pickup_location_id=L/year=Y/month=M/day=D/hour=H/*.csv
Sinks overwrite only the partitions they write (dynamic partition overwrite),
so re-running a month replaces that month and nothing else.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PREDICTION_CSV
from .mixed import read_months

MONTH_KEYS = ["year", "month"]
PREDICTION_KEYS = ["pickup_location_id", "year", "month", "day", "hour"]
#: Names of the files that ``write_predictions`` writes.
PREDICTION_PARTS = "part-*.csv"


# -------------------------------------------------------------------- scans
def read_trips(spark: SparkSession, base: str, year: int, month: int) -> DataFrame:
    """One landing month of raw trips.

    Only that month's folder is read ("month=1" as Spark writes it, or "month=01" as landed by hand);
    files of it with other physical types are cast to their common type (``mixed.read_months``).  The
    equality filter keeps the plan correct if both spellings are there.
    """
    return read_months(spark, base, [(year, month)]).where((F.col("year") == year) & (F.col("month") == month))


def read_demand(spark: SparkSession, base: str, years: list[int] | None = None) -> DataFrame:
    """All months of the listed years (absent months simply have no folder).

    With ``years`` only those year folders are listed (a glob under ``basePath``).
    """
    if not years:
        return spark.read.parquet(base)
    glob = f"{base.rstrip('/')}/year={{{','.join(str(y) for y in sorted(set(years)))}}}"
    try:
        df = spark.read.option("basePath", base).parquet(glob)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.read.parquet(base)
    return df.where(F.col("year").isin(list(years)))


def read_predictions(spark: SparkSession, base: str, years: list[int] | None = None,
                     file_glob: str = "prediction.csv", with_time: bool = True,
                     schema: T.StructType = PREDICTION_CSV) -> DataFrame:
    """Prediction CSVs with a header row; the five path keys become int columns.

    Files are matched by ``file_glob``: the original layout names every file
    ``prediction.csv``; ``write_predictions`` writes ``PREDICTION_PARTS``.
    ``with_time=False`` reads files that have no time column.  With ``years``
    only those year folders are listed.  Folders whose key value is not a
    number carry a null key and are dropped.
    """
    if not with_time:
        schema = T.StructType([f for f in schema.fields if f.name != "prediction_datetime"])
    reader = (spark.read.option("header", True).option("pathGlobFilter", file_glob)
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
              .option("enforceSchema", False).schema(schema))
    if years:
        glob = f"{base.rstrip('/')}/pickup_location_id=*/year={{{','.join(str(y) for y in sorted(set(years)))}}}"
        try:
            df = reader.option("basePath", base).csv(glob)
        except Exception as e:  # no such year: an empty part of the lake
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            df = reader.csv(base)
    else:
        df = reader.csv(base)
    for k in PREDICTION_KEYS:
        if k not in df.columns:
            raise ValueError(f"prediction folder key {k!r} missing under {base}")
    # A stray non-numeric folder makes partition inference type that key as
    # string; cast back and drop such folders' rows (only digit-valued keys count).
    df = df.withColumns({k: F.col(k).try_cast("int") for k in PREDICTION_KEYS})
    df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in PREDICTION_KEYS]))
    if years:
        df = df.where(F.col("year").isin(list(years)))
    return df


# -------------------------------------------------------------------- sinks
def write_partitioned(df: DataFrame, path: str, keys: list[str] = MONTH_KEYS,
                      sort_by: list[str] | None = None, fmt: str = "parquet",
                      mode: str = "overwrite", **options) -> str:
    """Partitioned write that replaces only the partitions present in ``df``.

    Rows are sorted within each task by ``sort_by`` so files carry tight
    min/max statistics (row-group skipping on location/time predicates).
    No global sort and no per-partition repartition: a hot month is spread
    over as many tasks as its input has, instead of landing in one task.
    """
    out = df.sortWithinPartitions(*keys, *(sort_by or []))
    w = (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).format(fmt))
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def drop_stale_months(spark: SparkSession, path: str, written: dict[tuple[int, int], bool]) -> None:
    """After a run that owns some months: remove folders of theirs that it did not write.

    ``written``: (year, month) to whether the run wrote rows for it.  A month without rows loses its
    folder, in either spelling of the month; one with rows loses the zero-padded spelling, which would
    be read as a second copy.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for (year, month), rows in written.items():
        own, padded = f"{path}/year={year}/month={month}", f"{path}/year={year}/month={month:02d}"
        for folder in {own, padded} - ({own} if rows else set()):
            if fs.exists(hadoop(folder)):
                fs.delete(hadoop(folder), True)


def write_clean_trips(clean: DataFrame, path: str) -> str:
    """Sink of cleaned trips, partitioned by landing month."""
    return write_partitioned(clean, path, sort_by=["pickup_location_id", "pickup_datetime"])


def write_demand(demand: DataFrame, path: str) -> str:
    """Sink of the hourly series, narrowed to the served types and sorted.

    A month of the series is bounded by the calendar (hours x locations), so
    each month is one task and one file, ordered by location and hour; no
    sampling pass runs the series a second time.
    """
    from .serve import conform
    from ..schemas import TAXI_RIDES
    narrow = conform(demand, TAXI_RIDES)
    return write_partitioned(narrow.repartition(*MONTH_KEYS), path, sort_by=["pickup_location_id", "pickup_hour"])


def write_predictions(pred: DataFrame, path: str, with_time: bool = True) -> str:
    """Predictions as header CSVs in the location/year/month/day/hour layout.

    ``with_time=False`` leaves the time out of the file (only the path keys
    carry it), the other layout the served loader accepts.
    """
    keyed = prediction_keys(pred)
    if not with_time:
        keyed = keyed.drop("prediction_datetime")
    # One folder per location-hour: cluster the rows of a location-day into one
    # task (exactly one file per folder) and spread the days over every core.
    # An explicit partition count keeps AQE from coalescing the write to one task.
    n = pred.sparkSession.sparkContext.defaultParallelism
    spread = keyed.repartition(n, *PREDICTION_KEYS[:-1])
    return write_partitioned(spread, path, keys=PREDICTION_KEYS, fmt="csv", header=True,
                             timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


def prediction_keys(pred: DataFrame) -> DataFrame:
    """Predictions with the five folder keys derived from the prediction time."""
    h = F.col("prediction_datetime")
    return pred.select(
        h, F.col("predicted_rides"),
        F.col("pickup_location_id"), F.year(h).alias("year"), F.month(h).alias("month"),
        F.dayofmonth(h).alias("day"), F.hour(h).alias("hour"))


def landed_months(spark: SparkSession, base: str) -> DataFrame:
    """(year, month) folders with files under ``base``, from their names: no file is opened."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/year=*/month=*/[^_.]*")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {re.search(r"/year=(\d+)/month=(\d+)/[^/]*$", f.getPath().toString()) for f in fs.globStatus(folder) or []}
    months = sorted({(int(m[1]), int(m[2])) for m in names if m})
    return spark.createDataFrame(months, "year int, month int")


def missing_months(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested (year, month) pairs that have not landed yet (anti-join)."""
    return requested.select(*MONTH_KEYS).distinct().join(existing.select(*MONTH_KEYS),
                                                         MONTH_KEYS, "left_anti")
