"""Co-located tables, rebuilding changed months only, metrics that merge and can be withdrawn."""
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001
from ridegrid import fixtures as fx
from ridegrid.operators import clean as C
from ridegrid.operators import metrics as M
from ridegrid.operators import series as S
from ridegrid.plans.monthly_job import run_changed
from ridegrid.schemas import PREDICTED_RIDES, TAXI_RIDES
from ridegrid.session import scratch_path
from ridegrid.sources import lake as L
from ridegrid.sources import manifest as MF
from ridegrid.sources import serve as SV


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def demand(spark):
    path = scratch_path(spark, "state-demand")
    S.backfill(fx.trips(spark, SF001)).write.parquet(path)
    return spark.read.parquet(path)


def test_tables_join_without_an_exchange(spark, demand):
    path = scratch_path(spark, "tables")
    keys = ["pickup_location_id", "pickup_hour"]
    half = demand.where("pickup_location_id % 2 = 0")
    SV.save_table(demand.limit(3), "t_actual", keys, 4, schema=TAXI_RIDES, path=f"{path}/a")
    SV.save_table(half, "t_actual", keys, 4, schema=TAXI_RIDES, path=f"{path}/a")  # replaced, not added to
    actual = SV.save_table(demand.where("pickup_location_id % 2 = 1"), "t_actual", keys, 4, "append", TAXI_RIDES, f"{path}/a")
    assert actual.count() == demand.count()
    pred = SV.save_table(fx.predictions_from_demand(demand), "t_pred", ["pickup_location_id", "prediction_datetime"], 4,
                         schema=PREDICTED_RIDES, path=f"{path}/p")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = M.actual_vs_predicted(actual, pred)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        got = rows(pairs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert got == rows(M.actual_vs_predicted(demand, fx.predictions_from_demand(demand)))
    spark.sql("DROP TABLE t_actual")
    spark.sql("DROP TABLE t_pred")


def test_only_changed_months_are_rebuilt(spark):
    base = scratch_path(spark, "changes")
    raw, clean, demand, manifest = (f"{base}/{x}" for x in ("raw", "clean", "demand", "manifest"))
    trips = C.assign_landing_month(fx.trips(spark, SF001))
    L.write_partitioned(trips, raw)
    months = {(r["year"], r["month"]) for r in trips.select("year", "month").distinct().collect()}
    assert {x[:2] for x in run_changed(spark, raw, clean, demand, manifest)} == months
    assert run_changed(spark, raw, clean, demand, manifest) == []

    def files(path, year, month):
        folder = f"{path}/year={year}/month={month}".replace("file:", "")
        return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")}

    first, other = sorted(months)[-1], sorted(months)[0]
    untouched = files(demand, *other)
    # one more file inside a month's folder; then a file replaced by another; then a file removed
    more = trips.where((F.col("year") == first[0]) & (F.col("month") == first[1])).limit(40)
    for change in ("append", "overwrite"):
        L.write_partitioned(more, raw, mode=change)
        assert run_changed(spark, raw, clean, demand, manifest) == [(*first, "replaced")]
        assert files(demand, *other) == untouched
        want = S.backfill(spark.read.parquet(raw)).select("year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"), "rides")
        got = spark.read.parquet(demand).select("year", "month", "pickup_hour", F.col("pickup_location_id").cast("int"), F.col("rides").cast("int"))
        assert rows(got) == rows(want)
    L.drop_stale_months(spark, raw, {other: False})
    assert run_changed(spark, raw, clean, demand, manifest) == [(*other, "removed")]
    assert {(r["year"], r["month"]) for r in L.landed_months(spark, demand).collect()} == months - {other}
    assert run_changed(spark, raw, clean, demand, manifest) == []


def test_fingerprints_read_no_contents(spark):
    base = scratch_path(spark, "prints")
    L.write_partitioned(C.assign_landing_month(fx.trips(spark, SF001)), base)
    plan = MF.month_states(spark, base)._jdf.queryExecution().executedPlan().toString()
    schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schema and all("content" not in line.split("ReadSchema")[1] for line in schema)
    assert MF.month_states(spark, base).agg(F.sum("files")).first()[0] >= 2
    assert MF.recorded_states(spark, f"{base}-none").collect() == []


def test_withdrawn_sums_leave_nothing(spark, demand):
    month = [F.year("pickup_hour").alias("year"), F.month("pickup_hour").alias("month")]
    pairs = M.actual_vs_predicted(demand, fx.predictions_from_demand(demand)).select("*", *month)
    by = ["year", "month", "pickup_location_id"]
    stored = M.metric_sums(pairs, by)
    new = pairs.where("year = 2024").withColumn("predicted_rides", F.col("predicted_rides") * 2)
    total = M.merged_sums([(stored, 1), (stored.where("year = 2024"), -1), (M.metric_sums(new, by), 1)], by)
    recount = M.metric_sums(pairs.where("year <> 2024").unionByName(new), by)
    assert rows(total) == rows(recount)
    assert M.merged_sums([(stored, 1), (stored, -1)], by).collect() == []
    for group in ([], ["pickup_location_id"]):
        a = rows(M.metrics_of_sums(stored, group))
        b = rows(M.forecast_metrics(pairs, group or None))
        assert [[round(v, 8) if isinstance(v, float) else v for v in r] for r in a] == [
            [round(v, 8) if isinstance(v, float) else v for v in r] for r in b]
    nothing = M.metrics_of_sums(stored.limit(0)).first()
    assert (nothing["mae"], nothing["mape"], nothing["n_pairs"]) == (None, None, 0)
