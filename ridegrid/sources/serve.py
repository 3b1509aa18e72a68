"""Served tables: declared schemas, replace / append sinks, insert-if-absent."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL_RANGE = {
    T.ByteType: (-(2 ** 7), 2 ** 7 - 1),
    T.ShortType: (-(2 ** 15), 2 ** 15 - 1),
    T.IntegerType: (-(2 ** 31), 2 ** 31 - 1),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast, and fail on integer overflow.

    The range check is explicit (``raise_error``), so it holds whatever the
    session's ANSI setting is; a value that does not fit is never wrapped.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        bounds = _INTEGRAL_RANGE.get(type(f.dataType))
        if bounds is not None:
            lo, hi = bounds
            c = F.when(c.isNull() | c.between(lo, hi), c).otherwise(
                F.raise_error(F.concat(F.lit(f"value out of range for {f.name} "
                                             f"{f.dataType.simpleString()}: "),
                                       c.cast("string"))))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def serve(df: DataFrame, path: str, mode: str = "overwrite",
          schema: T.StructType | None = None) -> str:
    """Write a served table (``overwrite`` replaces it, ``append`` adds rows)."""
    out = conform(df, schema) if schema is not None else df
    out.write.mode(mode).parquet(path)
    return path


def read_served(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_table(df: DataFrame, name: str, keys: list[str], buckets: int = 32, mode: str = "overwrite",
               schema: T.StructType | None = None, path: str | None = None) -> DataFrame:
    """A named, bucketed and sorted served table in the catalog; returns it.

    Rows are dealt to ``buckets`` files by the hash of ``keys`` and sorted by them, so tables with the same keys (of the
    same types) and buckets join without an exchange.  A table outlives the session where the
    catalog does; without ``path`` it lies in the catalog's warehouse.  ``append`` adds files to the
    same buckets.
    """
    out = conform(df, schema) if schema is not None else df
    writer = (out.repartition(buckets, *keys).write.mode(mode).format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def insert_if_absent(target: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``new`` whose key has no row in ``target``, appended to ``target``.

    Only distinct target keys are shuffled (semi-aggregated before the anti
    join); running it again with the same ``new`` adds nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = target.select(*[F.col(k).alias(f"_present_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_present_{k}")) for k in keys]  # a null key is a key
    fresh = new.join(present, reduce(lambda a, b: a & b, same), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name, keep duplicates, absent columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_predictions(df: DataFrame) -> DataFrame:
    """Served prediction rows: time from the path keys when the file has none."""
    from ..functions.time import from_parts
    from ..schemas import PREDICTED_RIDES
    if "prediction_datetime" not in df.columns:
        df = df.withColumn("prediction_datetime", from_parts("year", "month", "day", "hour"))
    return conform(df, PREDICTED_RIDES)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> str:
    """Expose a written table under a name (session view); ``spark.table(name)`` reads it."""
    spark.read.format(fmt).load(path).createOrReplaceTempView(name)
    return name


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table as a DataFrame (parallel reads when a partition column is given).

    Needs a reachable database and its JDBC driver on the classpath; nothing in
    this repository starts one, so this path is not exercised by the tests.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict | None = None, schema: T.StructType | None = None) -> None:
    """Served-table sink into a database (replace or append), after ``conform``."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
