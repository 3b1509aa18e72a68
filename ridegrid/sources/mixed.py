"""Months of one lake that were written with different physical types, read as one table.

A column may be a double in one month's files, a long in the next and an int in a third; one Parquet
scan over both fails.  Here the files are sorted by physical schema (from footers only), each
distinct schema is one scan with its own types, a type lattice gives one target per column, and the scans are
united after a cast to it.  A lake of one schema stays one plain scan; a column whose type is already the
target is not cast, so filters on it still reach the reader.  The number of scans is the number
of distinct schemas, not of months.

Lattice, upwards: void; byte, short, int, long; decimals wide enough for both; float, double.  A decimal or
integral with a float or double is a double (whole numbers beyond 2^53 lose their last digits).  date, then
timestamp, then timestamp_ntz (a zoned time is taken as wall-clock time of the session zone).  string is
above every atomic type.  Anything else that differs is an error that names the column and the two types.  Names
that differ in case only are one column, under the first spelling; a column that a file lacks is null there.
"""
from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["year", "month"]
_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_REAL = [T.FloatType(), T.DoubleType()]
_TIMES = [T.DateType(), T.TimestampType(), T.TimestampNTZType()]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in (_INTEGRAL, _REAL, _TIMES):
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    numeric = [isinstance(t, T.NumericType) for t in (a, b)]
    if all(numeric):
        if a in _REAL or b in _REAL:
            return T.DoubleType()
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[t.simpleString()], 0) for t in (a, b)]
        whole, scale = (max(s) for s in zip(*sizes, strict=True))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        other = b if isinstance(a, T.StringType) else a
        if isinstance(other, T.AtomicType):
            return T.StringType()
    raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def target_schema(schemas: list[T.StructType]) -> T.StructType:
    """One column per name (whatever its case) with the common type of all schemas."""
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            try:
                kinds[key] = common_type(kinds[key], f.dataType) if key in kinds else f.dataType
            except TypeError as e:
                raise TypeError(f"column {names[key]!r}: {e}") from None
    return T.StructType([T.StructField(names[k], t) for k, t in kinds.items()])


def conformed(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with exactly the target's columns; only columns of another type are cast."""
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in target.fields:
        own = have.get(f.name.lower())
        if own is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif own.dataType == f.dataType:
            cols.append(F.col(f"`{own.name}`").alias(f.name))
        else:
            cols.append(F.col(f"`{own.name}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted; hidden files are left out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in fs.globStatus(path) or [])


def month_folders(spark: SparkSession, base: str, months: list[tuple[int, int]] | None = None) -> list[str]:
    """Folders of the landed months that hold files; with ``months`` only theirs, in either spelling of the month.

    Rows landed without a month lie in folders of no number; they are listed when no months are asked for.
    """
    found = {p.rsplit("/", 1)[0] for p in listed(spark, f"{base.rstrip('/')}/year=*/month=*/[^_.]*")}
    if months is not None:
        asked = set(months)
        keys = {p: re.search(r"/year=(\d+)/month=(\d+)$", p) for p in found}
        found = {p for p, m in keys.items() if m and (int(m[1]), int(m[2])) in asked}
    return sorted(found)


def _merged(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The schema of all files below ``paths``, or None when their types differ (Spark reads the footers)."""
    try:
        schema = spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" in str(e):
            return None
        raise
    return T.StructType([f for f in schema.fields if f.name not in KEYS])


def physical_schemas(spark: SparkSession, folders: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, folders or files that have it): one pair for a lake of one schema.

    Folders are looked at one by one only if they differ, files only in a folder whose own files differ.
    """
    whole = _merged(spark, folders)
    if whole is not None:
        return [(whole, folders)]

    def of(folder: str) -> list[tuple[T.StructType, str]]:
        schema = _merged(spark, [folder])
        if schema is not None:
            return [(schema, folder)]
        files = listed(spark, f"{folder}/[^_.]*")
        return [(_merged(spark, [f]), f) for f in files]

    with ThreadPoolExecutor(8) as pool:  # footers only, one small job a folder
        found = [pair for pairs in pool.map(of, folders) for pair in pairs]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, path in found:
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())


def read_months(spark: SparkSession, base: str, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """All (or the asked) landed months as one table with ``year`` and ``month``, whatever types each was written with.

    Columns keep the order of the first schema.  Without any landed month of those asked for: an empty table
    with the lake's columns.
    """
    folders = month_folders(spark, base, months)
    if not folders:
        rows = spark.read.parquet(base)
        return rows if months is None else rows.where(F.lit(False))
    keys = [T.StructField(k, T.IntegerType()) for k in KEYS]
    groups = physical_schemas(spark, folders)
    target = T.StructType([*target_schema([s for s, _ in groups]).fields, *keys])
    parts = [conformed(spark.read.option("basePath", base).schema(T.StructType([*schema.fields, *keys])).parquet(*paths),
                       target) for schema, paths in groups]
    return reduce(DataFrame.unionByName, parts)
