"""End-to-end jobs over a lake: monthly job, many-month job, landing stream."""
import os

from pyspark.sql import functions as F

from paths import SF001
from ridegrid import fixtures as fx
from ridegrid.operators import clean as C
from ridegrid.operators import series as S
from ridegrid.plans.monthly_job import run_backfill, run_month
from ridegrid.session import scratch_path
from ridegrid.sources import lake as L
from ridegrid.streaming.landing import start_landing_stream


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_month_matches_fixture_and_is_idempotent(spark):
    raw = scratch_path(spark, "job-raw")
    # the whole trips table is the landed 2024-01 file
    L.write_partitioned(C.with_landing_month(fx.trips(spark, SF001), 2024, 1), raw)
    out = scratch_path(spark, "job-out")
    stats = run_month(spark, raw, f"{out}/clean", f"{out}/demand", 2024, 1).first()
    assert (stats.total_records, stats.valid_records) == (1000, 445)
    first = spark.read.parquet(f"{out}/demand")
    expected = fx.demand(spark, SF001)
    got = first.select(F.col("pickup_hour"), F.col("pickup_location_id").cast("int"),
                       F.col("rides").cast("int"))
    assert rows(got) == rows(expected)
    run_month(spark, raw, f"{out}/clean", f"{out}/demand", 2024, 1)
    assert spark.read.parquet(f"{out}/demand").count() == expected.count()
    assert spark.read.parquet(f"{out}/clean").count() == 445


def test_run_backfill_equals_backfill_operator(spark):
    raw = scratch_path(spark, "bf-raw")
    L.write_partitioned(C.assign_landing_month(fx.trips(spark, SF001)), raw)
    out = scratch_path(spark, "bf-out")
    stats = run_backfill(spark, raw, f"{out}/clean", f"{out}/demand")
    got = spark.read.parquet(f"{out}/demand").select(
        "year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"),
        F.col("rides").cast("int"))
    before = rows(got)
    assert before == rows(S.backfill(fx.trips(spark, SF001)))
    # the observed per-month waterfall equals the grouped one-pass statistics
    assert rows(stats) == rows(C.clean_stats(spark.read.parquet(raw)))
    # rebuilding one month replaces only that month
    run_backfill(spark, raw, f"{out}/clean", f"{out}/demand", months=[(2023, 12)])
    again = spark.read.parquet(f"{out}/demand").select(
        "year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"),
        F.col("rides").cast("int"))
    assert rows(again) == before


def test_landing_stream_builds_landed_months(spark):
    raw = scratch_path(spark, "stream-raw")
    trips = C.assign_landing_month(fx.trips(spark, SF001))
    L.write_partitioned(trips.where(F.col("year") == 2024), raw)
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    q = start_landing_stream(spark, raw, f"{out}/clean", f"{out}/demand", ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    months = {(r.year, r.month) for r in
              spark.read.parquet(f"{out}/demand").select("year", "month").distinct().collect()}
    assert months == {(2024, 1)}
    # a later landing (the 2023 months) is picked up by the next run, earlier months kept
    L.write_partitioned(trips.where(F.col("year") == 2023), raw, mode="append")
    q = start_landing_stream(spark, raw, f"{out}/clean", f"{out}/demand", ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(f"{out}/demand").select(
        "year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"),
        F.col("rides").cast("int"))
    assert rows(got) == rows(S.backfill(fx.trips(spark, SF001)))
    assert os.path.isdir(ckpt.replace("file:", ""))


def test_run_month_stats_equal_one_pass_stats_and_empty_month(spark):
    from paths import SF01
    raw = scratch_path(spark, "job-raw2")
    L.write_partitioned(C.with_landing_month(fx.trips(spark, SF01), 2024, 1), raw)
    out = scratch_path(spark, "job-out2")
    observed = run_month(spark, raw, f"{out}/clean", f"{out}/demand", 2024, 1).first().asDict()
    assert observed == C.clean_stats(fx.trips(spark, SF01), 2024, 1).first().asDict()
    # a month that never landed: empty layers, zero counts, null percentage
    empty = run_month(spark, raw, f"{out}/clean", f"{out}/demand", 2024, 5).first()
    assert empty.total_records == 0 and empty.percent_dropped is None


def test_prediction_scan_skips_non_numeric_folders(spark):
    import datetime as dt
    base = scratch_path(spark, "pred-junk")
    pred = spark.createDataFrame(
        [(43, dt.datetime(2024, 1, 5, 3), 7), (74, dt.datetime(2023, 12, 31, 22), 2)],
        "pickup_location_id int, prediction_datetime timestamp_ntz, predicted_rides int")
    L.write_predictions(pred, base)
    junk = base.replace("file:", "") + "/pickup_location_id=notes/year=2024/month=1/day=5/hour=3"
    os.makedirs(junk)
    with open(junk + "/part-0.csv", "w") as f:
        f.write("prediction_datetime,predicted_rides\n2024-01-05 03:00:00,99\n")
    got = L.read_predictions(spark, base, [2024], L.PREDICTION_PARTS).collect()
    assert [(r.pickup_location_id, r.year, r.hour, r.predicted_rides) for r in got] == [(43, 2024, 3, 7)]
    assert dict(L.read_predictions(spark, base, file_glob=L.PREDICTION_PARTS).dtypes)["pickup_location_id"] == "int"
