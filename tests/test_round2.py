"""A run owns its months; no row is lost for a missing key; bounds follow their parameters."""
import datetime as dt

from pyspark.sql import functions as F

from ridegrid.operators import clean as C
from ridegrid.operators.forecast import demand_forecast
from ridegrid.operators.clean import with_landing_month
from ridegrid.plans.monthly_job import run_backfill, run_month
from ridegrid.plans.served import demand_range
from ridegrid.session import scratch_path
from ridegrid.sources.lake import (PREDICTION_PARTS, landed_months, read_predictions, write_partitioned,
                                   write_predictions)
from ridegrid.sources.serve import insert_if_absent, load_predictions
from ridegrid.sources.typing import infer_column_types, to_text, typed_result

COLS = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
        "trip_distance double, total_amount double, fare_amount double, tip_amount double, payment_type int, "
        "passenger_count double")


def trips(spark, amounts):
    t = dt.datetime(2024, 1, 5, 10)
    return spark.createDataFrame([(t, t + dt.timedelta(minutes=9), 43, 74, 1.5, a, 1.0, 0.0, 1, 1.0) for a in amounts], COLS)


def roots(spark, raw):
    base = scratch_path(spark, "own-months")
    lake = f"{base}/raw"
    write_partitioned(raw, lake)
    return lake, f"{base}/clean", f"{base}/demand"


def test_rerun_of_an_emptied_month_leaves_nothing(spark):
    good = with_landing_month(trips(spark, [10.0] * 5), 2024, 1)
    bad = with_landing_month(trips(spark, [0.5] * 4), 2024, 1)
    for job in (lambda *p: run_month(spark, *p, 2024, 1), lambda *p: run_backfill(spark, *p)):
        lake, clean, demand = roots(spark, good)
        assert job(lake, clean, demand).first()["valid_records"] == 5
        assert spark.read.parquet(clean).count() == 5
        write_partitioned(bad, lake)
        assert job(lake, clean, demand).first()["valid_records"] == 0
        for path, schema in ((clean, "total_amount double, year int, month int"), (demand, "rides int, year int, month int")):
            assert spark.read.schema(schema).parquet(path).count() == 0


def test_empty_month_on_fresh_output(spark):
    lake, clean, demand = roots(spark, with_landing_month(trips(spark, [0.5] * 4), 2024, 1))
    assert run_month(spark, lake, clean, demand, 2024, 1).first()["valid_records"] == 0
    assert run_backfill(spark, lake, f"{clean}2", f"{demand}2").first()["total_records"] == 4


def test_backfill_counts_rows_landed_without_a_month(spark):
    raw = with_landing_month(trips(spark, [10.0] * 5), 2024, 1).unionByName(
        trips(spark, [10.0] * 3).withColumns({"year": F.lit(None).cast("int"), "month": F.lit(None).cast("int")}))
    stats = run_backfill(spark, *roots(spark, raw))
    assert stats.agg(F.sum("total_records")).first()[0] == 8
    some = run_backfill(spark, *roots(spark, raw), months=[(2024, 1), (2024, 2)]).orderBy("month").collect()
    assert [(r["month"], r["total_records"]) for r in some] == [(1, 5), (2, 0)]


def test_range_keeps_rows_without_keys(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05 10:00:00' as pickup_hour, 1 as rides, 2024 as year, 1 as month "
                   "union all select timestamp_ntz'2024-01-05 11:00:00', 2, null, null")
    assert demand_range(df, "2024-01-05 00:00:00", "2024-01-06 00:00:00").count() == 2


def test_null_key_is_inserted_once(spark):
    new = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    once = insert_if_absent(new.limit(0), new, "k")
    assert once.count() == 2 and insert_if_absent(once, new, "k").count() == 2


def test_month_bounds_follow_p_and_error(spark):
    df = with_landing_month(trips(spark, [float(i) for i in range(1, 1001)]), 2024, 1)
    half = C.month_bounds(df, 2024, 1, rel_err=0.001, p=0.5).first().asDict()
    exact = C.month_bounds(df, 2024, 1, rel_err=0, p=0.5).first().asDict()
    top = [v for k, v in half.items() if "amount" in k][0]
    assert abs(top - 500) <= 2 and abs([v for k, v in exact.items() if "amount" in k][0] - 500) <= 1


def test_text_keeps_fractions_and_dates(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 05:00:00.179575' as a, timestamp_ntz'2024-01-02 00:00:00' as b")
    assert tuple(to_text(df).first()) == ("2024-01-01 05:00:00.179575", "2024-01-02 00:00:00")
    assert infer_column_types(to_text(df)).collect() == df.collect()
    text = spark.createDataFrame([("2024-01-01 05:00:00.000", "2024-01-01", "2024", "2024-13-01"), ("", "2024-01-02", "", "")],
                                 "a string, b string, c string, d string")
    got = infer_column_types(text)
    assert [t for _, t in got.dtypes] == ["timestamp_ntz", "timestamp_ntz", "bigint", "string"]
    first = got.collect()[0]
    assert first["a"] == dt.datetime(2024, 1, 1, 5) and first["b"] == dt.datetime(2024, 1, 1)
    typed = typed_result(text.select("a", "b"), {"a": "timestamp_ntz", "b": "timestamp_ntz"}).collect()
    assert typed[0]["a"] == dt.datetime(2024, 1, 1, 5) and typed[0]["b"] == dt.datetime(2024, 1, 1) and typed[1]["a"] is None


def test_forecast_does_not_see_later_actuals(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=h), loc, (h % 24) * loc + h // 168) for h in range(24 * 15) for loc in (1, 2)]
    series = spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pickup_location_id int, rides int")
    cut = start + dt.timedelta(days=12)
    later = series.withColumn("rides", F.when(F.col("pickup_hour") >= F.lit(cut).cast("timestamp_ntz"), F.col("rides") + 50)
                              .otherwise(F.col("rides")))
    key = ["pickup_location_id", "prediction_datetime"]
    one, two = (demand_forecast(s, cut, max_iter=3).orderBy(*key).collect() for s in (series, later))
    assert one == two and len(one) == 2 * 24 * 3


def test_prediction_files_without_time(spark):
    base = scratch_path(spark, "no-time")
    t = dt.datetime(2024, 1, 5, 7)
    pred = spark.createDataFrame([(43, t, 5), (74, t + dt.timedelta(hours=1), 0)],
                                 "pickup_location_id int, prediction_datetime timestamp_ntz, predicted_rides int")
    write_predictions(pred, base, with_time=False)
    got = load_predictions(read_predictions(spark, base, [2024], PREDICTION_PARTS, with_time=False))
    assert sorted(map(tuple, got.collect())) == [(43, t, 5), (74, t + dt.timedelta(hours=1), 0)]
    assert read_predictions(spark, base, [2023], PREDICTION_PARTS, with_time=False).count() == 0
    assert read_predictions(spark, base, with_time=False).count() == 0  # no file of the original name


def test_landed_months_are_read_from_folder_names(spark):
    lake, _, _ = roots(spark, with_landing_month(trips(spark, [10.0]), 2024, 1).unionByName(
        with_landing_month(trips(spark, [10.0]), 2023, 12)))
    months = landed_months(spark, lake)
    assert sorted(map(tuple, months.collect())) == [(2023, 12), (2024, 1)]
    assert "FileScan" not in months._jdf.queryExecution().toString()
