"""The series operators see every month of the trips, and lags cross a month's edge."""
import pytest
from pyspark.sql import functions as F

from paths import SF01
from ridegrid.plans.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["lag_features", "forecast_metrics", "location_summary", "row_counts", "infer_types_trips",
                                  "insert_if_absent", "serve_append", "serve_replace", "demand_forecast_keys", "location_names"])
def test_series_queries_run_over_all_months(name):
    assert "bprep" in ORACLE[name] and f"{name}_all_months" not in QUERIES


def test_lags_and_trips_of_all_months(spark):
    lags = QUERIES["lag_features"](spark, SF01)
    months = lags.groupBy(F.date_format("pickup_hour", "yyyy-MM").alias("m")).count().collect()
    assert len(months) > 1
    # the trips moved 40 days back run from November into December 2023
    first_week = lags.where("pickup_hour >= timestamp_ntz '2023-12-01 00:00:00' "
                            "and pickup_hour < timestamp_ntz '2023-12-08 00:00:00'")
    assert first_week.where("lag_168 is not null").count() > 0
