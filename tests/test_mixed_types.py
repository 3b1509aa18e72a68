"""Months with different physical types: the lattice, the reader and the many-month job."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF001
from ridegrid import fixtures as fx
from ridegrid.operators import series as S
from ridegrid.plans.monthly_job import run_backfill, run_month
from ridegrid.session import scratch_path
from ridegrid.sources import lake as L
from ridegrid.sources import mixed as M


def t(ddl):
    return T._parse_datatype_string(ddl) if not isinstance(ddl, T.DataType) else ddl


@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("bigint", "double", "double"),
    ("int", "float", "double"), ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("decimal(38,0)", "decimal(10,5)", "double"), ("decimal(10,2)", "float", "double"), ("date", "timestamp", "timestamp"),
    ("timestamp", "timestamp_ntz", "timestamp_ntz"), ("string", "bigint", "string"), ("void", "int", "int"),
])
def test_lattice(spark, a, b, both):
    for x, y in ((a, b), (b, a)):
        assert M.common_type(t(x), t(y)).simpleString() == both
    assert M.common_type(t(both), t(a)) == t(both)


def test_lattice_is_associative(spark):
    kinds = [t(x) for x in ("void", "tinyint", "int", "bigint", "decimal(10,2)", "float", "double")]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                assert M.common_type(M.common_type(a, b), c) == M.common_type(a, M.common_type(b, c))


def test_types_without_a_common_one_are_named(spark):
    one, two = T.StructType().add("Flag", T.BooleanType()), T.StructType().add("flag", T.IntegerType())
    with pytest.raises(TypeError, match="'Flag'.*boolean.*int"):
        M.target_schema([one, two])


@pytest.fixture(scope="module")
def lake(spark):
    base = scratch_path(spark, "mixed")
    fx.write_mixed_lake(spark, SF001, base)
    return base


def test_scans_are_as_many_as_schemas(spark, lake):
    folders = M.month_folders(spark, lake)
    groups = M.physical_schemas(spark, folders)
    months = {f.rsplit("/year=", 1)[1] for f in folders}
    assert len(groups) == len({(int(m.split("/month=")[0]) * 12 + int(m.split("/month=")[1])) % 3 for m in months}) > 1
    df = M.read_months(spark, lake)
    kinds = dict(df.dtypes)
    assert (kinds["passenger_count"], kinds["PULocationID"], kinds["trip_distance"]) == ("double", "double", "double")
    assert kinds["tpep_dropoff_datetime"] == "timestamp_ntz" and kinds["payment_type"] == "string"
    assert len({c.lower() for c in df.columns}) == len(df.columns) and "airport_fee" in df.columns
    plan = df.where("tpep_pickup_datetime >= timestamp_ntz '2024-01-01 00:00:00' and year = 2024")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text  # not cast: still pushed down


def test_rows_are_those_of_the_trips(spark, lake):
    names = fx.trips(spark, SF001).columns
    want = fx.trips(spark, SF001).select(*[F.col(c).cast("double").alias(c) if "time" not in c else c for c in names])
    got = M.read_months(spark, lake).select(*[F.col(c).cast("double").alias(c) if "time" not in c else c for c in names])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_jobs_equal_the_operator(spark, lake):
    out = scratch_path(spark, "mixed-out")

    def demand(path):
        return sorted(tuple(r) for r in spark.read.parquet(path).select(
            "year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"), F.col("rides").cast("int")).collect())

    run_backfill(spark, lake, f"{out}/clean", f"{out}/demand")
    want = sorted(tuple(r) for r in S.backfill(fx.trips(spark, SF001)).collect())
    assert demand(f"{out}/demand") == want
    for year, month in {(r[0], r[1]) for r in want}:
        run_month(spark, lake, f"{out}/clean1", f"{out}/demand1", year, month)
    assert demand(f"{out}/demand1") == want


def test_one_month_with_files_of_different_types(spark):
    base = scratch_path(spark, "mixed-month")
    time = dt.datetime(2024, 1, 5, 10)
    for kind, n in (("double", 2), ("bigint", 3), ("string", 4)):
        rows = spark.createDataFrame([(time, time + dt.timedelta(minutes=9), 43, 74, 1.5, 10.0, 1.0, 0.0, 1, 1)] * n, (
            "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
            "trip_distance double, total_amount double, fare_amount double, tip_amount double, payment_type int, passenger_count int"))
        rows = rows.withColumn("passenger_count", F.col("passenger_count").cast(kind))
        L.write_partitioned(rows.withColumns({"year": F.lit(2024), "month": F.lit(1)}), base, mode="append")
    assert L.read_trips(spark, base, 2024, 1).count() == 9 and L.read_trips(spark, base, 2024, 2).count() == 0
    out = scratch_path(spark, "mixed-month-out")
    stats = run_backfill(spark, base, f"{out}/clean", f"{out}/demand").first()
    assert (stats["total_records"], stats["valid_records"]) == (9, 9)


def test_text_that_is_no_number_is_a_missing_value(spark):
    base = scratch_path(spark, "mixed-text")
    time = dt.datetime(2024, 1, 5, 10)
    rows = spark.createDataFrame([(time, time + dt.timedelta(minutes=9), 43, 74, 1.5, a, 1.0, 0.0, 1, 1.0) for a in ("10.5", "n/a")], (
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
        "trip_distance double, total_amount string, fare_amount double, tip_amount double, payment_type int, passenger_count double"))
    L.write_partitioned(rows.withColumns({"year": F.lit(2024), "month": F.lit(1)}), base)
    stats = run_backfill(spark, base, f"{base}-clean", f"{base}-demand").first()
    assert (stats["valid_records"], stats["dropped_missing"]) == (1, 1)
