"""O1, O2: the orders that sinks and range queries promise."""
import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from ridegrid.plans import served as Q
from ridegrid.sources import lake as L

START = dt.datetime(2024, 1, 30)


@pytest.fixture(scope="module")
def demand(spark):
    rows = [(START + dt.timedelta(hours=(i * 37) % 72), loc, (i * loc) % 9) for i in range(72) for loc in (132, 4, 43)]
    return spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pickup_location_id int, rides int").repartition(7, "rides")


def test_demand_files_are_sorted_by_location_and_hour(spark, demand, tmp_path):
    keyed = demand.selectExpr("*", "year(pickup_hour) as year", "month(pickup_hour) as month")
    L.write_demand(keyed, str(tmp_path / "demand"))
    files = list(Path(tmp_path / "demand").rglob("*.parquet"))
    assert len(files) == 2  # a file a month
    total = 0
    for f in files:
        t = pq.ParquetFile(f).read(["pickup_location_id", "pickup_hour"])
        rows = list(zip(t["pickup_location_id"].to_pylist(), t["pickup_hour"].to_pylist(), strict=True))
        assert rows == sorted(rows)
        total += len(rows)
    assert total == 216


def test_range_query_comes_in_time_order(demand):
    got = [r["pickup_hour"] for r in Q.demand_range(demand, "2024-01-30 05:00:00", "2024-02-01 03:00:00").collect()]
    assert len(got) == 47 * 3 and got == sorted(got)


def test_location_series_and_week_come_in_time_order(demand):
    pred = demand.selectExpr("pickup_location_id", "pickup_hour as prediction_datetime", "rides as predicted_rides")
    for frames in (Q.location_series(demand, pred, 43), Q.location_week(demand, pred, "2025-01-30 12:00:00", 43)):
        for df in frames:
            times = [r[0] if not isinstance(r[0], int) else r[1] for r in df.collect()]
            assert len(times) > 20 and times == sorted(times)
