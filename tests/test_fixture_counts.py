"""The waterfall and series figures of FIXTURES.md, from the Spark side."""
import pytest
from pyspark.sql import functions as F

from paths import SF001, SF01
from ridegrid import fixtures as fx
from ridegrid.operators import clean as C
from ridegrid.operators import metrics as M

# sf: total, not null, in month, duration, amount, distance, location, passengers
WATERFALL = {
    SF001: [1000, 948, 939, 921, 884, 869, 717, 445],
    SF01: [10000, 9484, 9389, 9229, 8777, 8633, 8130, 5088],
}
SERIES = {SF001: (8616, 445, 2, 7908, 0.6215, 98.5258),
          SF01: (33840, 5088, 3, 31020, 0.6582, 96.1698)}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_waterfall(spark, sf):
    s = C.clean_stats(fx.trips(spark, sf), 2024, 1).first()
    left = [s.total_records]
    for stage in C.STAGES:
        left.append(left[-1] - s[f"dropped_{stage}"])
    assert left == WATERFALL[sf]
    assert s.valid_records == WATERFALL[sf][-1]
    assert s.records_dropped + s.valid_records == s.total_records


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_series_and_metrics(spark, sf):
    dem = fx.demand(spark, sf)
    pred = fx.predictions_from_demand(dem)
    agg = dem.agg(F.count("*"), F.sum("rides"), F.max("rides")).first()
    m = M.forecast_metrics(M.actual_vs_predicted(dem, pred)).first()
    rows, total, peak, n_pred, mae, mape = SERIES[sf]
    assert tuple(agg) == (rows, total, peak)
    assert pred.count() == n_pred
    assert round(m.mae, 4) == mae and round(m.mape, 4) == mape


def test_grid_invariants(spark):
    dem = fx.demand(spark, SF01)
    n_hours = dem.select("pickup_hour").distinct().count()
    n_locs = dem.select("pickup_location_id").distinct().count()
    assert dem.count() == n_hours * n_locs
    assert dem.select(F.sum("rides")).first()[0] == C.clean_trips(fx.trips(spark, SF01), 2024, 1).count()
