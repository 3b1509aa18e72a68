"""Plan checks: pushdown, pruning, no Python evaluation, no cartesian products."""
import pytest

from paths import SF001
from ridegrid import fixtures as fx
from ridegrid.operators import clean as C
from ridegrid.operators import series as S
from ridegrid.plans.registry import QUERIES
from ridegrid.session import scratch_path
from ridegrid.sources import lake as L

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    base = scratch_path(spark, "plan-lake")
    L.write_partitioned(C.assign_landing_month(fx.trips(spark, SF001)), base)
    return base


def test_month_scan_prunes_partitions_and_pushes_time_range(spark, lake):
    raw = L.read_trips(spark, lake, 2024, 1)
    p = plan(C.clean_trips(raw, 2024, 1))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in p
    assert "LessThan(tpep_pickup_datetime,2024-02-01T00:00)" in p


def test_counts_read_only_needed_columns(spark, lake):
    raw = L.read_trips(spark, lake, 2024, 1)
    counts = S.hourly_rides(C.finalize_trips(C.clean_trips(raw, 2024, 1)))
    schemas = [line for line in plan(counts).splitlines() if "ReadSchema" in line]
    assert schemas and all("fare_amount" not in s and "tip_amount" not in s for s in schemas)


def test_clean_layer_read_is_pruned_to_two_columns(spark, lake):
    out = scratch_path(spark, "plan-clean")
    L.write_clean_trips(C.finalize_trips(C.clean_trips(L.read_trips(spark, lake, 2024, 1), 2024, 1)),
                        out)
    counts = S.hourly_rides(spark.read.parquet(out))
    schema = [line for line in plan(counts).splitlines() if "ReadSchema" in line][0]
    assert "pickup_datetime" in schema and "pickup_location_id" in schema
    assert "fare_amount" not in schema and "dropoff" not in schema


@pytest.mark.parametrize("name", [n for n in QUERIES
                                  if n not in ("demand_forecast", "forecast_accuracy")])
def test_no_python_and_no_cartesian(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    assert not any(node in p for node in PYTHON_NODES), name
    assert "CartesianProduct" not in p, name


def test_quantile_bounds_are_a_broadcast_of_one_row_per_month(spark):
    p = plan(C.clean_trips(fx.trips(spark, SF001), 2024, 1, p=0.99, rel_err=0.001))
    assert "BroadcastExchange" in p and "percentile_approx" in p


def test_parity_clean_reads_trips_once(spark):
    p = plan(C.clean_trips(fx.trips(spark, SF001), 2024, 1))
    assert p.count("FileScan parquet") == 1
    assert "Exchange" not in p and "isnan" in p


def test_week_window_prunes_months_and_pushes_hours(spark):
    from ridegrid.operators import series as S
    from ridegrid.plans import served as Q
    base = scratch_path(spark, "plan-demand")
    L.write_demand(S.backfill(fx.trips(spark, SF001)), base)
    dem = spark.read.parquet(base)
    actual, _ = Q.location_week(dem, fx.predictions(spark, SF001), fx.WEEK_ANCHOR_UTC)
    p = plan(actual)
    assert "GreaterThanOrEqual(pickup_hour,2024-01-13T10:00)" in p
    assert "LessThanOrEqual(pickup_hour,2024-01-20T11:00)" in p
    part = p.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in part and "24289" in part  # 2024 * 12 + 1: only January is read
    rng = Q.demand_range(dem, "2023-12-01 00:00:00", "2023-12-31 23:00:00")
    assert "24288" in plan(rng).split("PartitionFilters: [")[1].split("]")[0]


def test_parity_bound_is_a_plain_max(spark):
    p = plan(C.upper_bounds(C._prepared(fx.trips(spark, SF001), 2024, 1)))
    assert "percentile_approx" not in p and "max(" in p
    p = plan(C.upper_bounds(C._prepared(fx.trips(spark, SF001), 2024, 1), p=0.5))
    assert "percentile_approx" in p
