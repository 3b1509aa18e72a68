import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ridegrid.operators import clean as C
from ridegrid.operators import metrics as M
from ridegrid.operators import series as S
from ridegrid.plans import served as Q
from ridegrid.sources import serve as SV
from ridegrid.sources import typing as TY

RAW = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
       "PULocationID int, DOLocationID int, trip_distance double, total_amount double, "
       "fare_amount double, tip_amount double, payment_type int, passenger_count double")


def trip(pickup="2024-01-10 08:15:00", seconds=600, pu=43, do=74, dist=1.5, amount=10.0,
         fare=7.0, tip=1.0, pay=1, pax=1.0):
    p = dt.datetime.fromisoformat(pickup) if pickup else None
    d = p + dt.timedelta(seconds=seconds) if (p is not None and seconds is not None) else None
    return (p, d, pu, do, dist, amount, fare, tip, pay, pax)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_null_vs_nan_and_unchecked_columns(spark):
    rows = [trip(dist=float("nan")), trip(fare=None, tip=None, pay=None), trip(dist=None)]
    nn = C.filter_not_null(frame(spark, rows))
    assert nn.count() == 2  # NaN is not null; fare/tip/payment are not checked
    out = C.clean_trips(frame(spark, rows), 2024, 1).collect()
    # NaN distance fails the upper bound (NaN sorts above every value)
    assert len(out) == 1 and out[0].fare_amount is None


def test_range_edges(spark):
    rows = [trip(amount=2.5), trip(amount=2.49), trip(seconds=0), trip(seconds=1),
            trip(pax=0.0), trip(pax=5.0), trip(pax=6.0), trip(dist=0.0),
            trip(pu=1), trip(pu=264), trip(pu=265)]
    kept = C.clean_trips(frame(spark, rows), 2024, 1)
    got = sorted((r.total_amount, r.duration, r.passenger_count) for r in kept.collect())
    assert got == sorted([(2.5, 600, 1.0), (10.0, 1, 1.0), (10.0, 600, 5.0)])
    stats = C.clean_stats(frame(spark, rows), 2024, 1).first()
    assert (stats.dropped_total_amount, stats.dropped_duration, stats.dropped_passenger_count,
            stats.dropped_distance, stats.dropped_location) == (1, 1, 2, 1, 3)


def test_december_rollover(spark):
    rows = [trip("2023-12-31 23:59:59"), trip("2024-01-01 00:00:00"), trip("2023-12-01 00:00:00")]
    dec = C.filter_in_month(frame(spark, rows), 2023, 12).collect()
    assert sorted(str(r.tpep_pickup_datetime) for r in dec) == [
        "2023-12-01 00:00:00", "2023-12-31 23:59:59"]
    jan = C.filter_in_month(frame(spark, rows), 2024, 1).collect()
    assert [str(r.tpep_pickup_datetime) for r in jan] == ["2024-01-01 00:00:00"]


def test_one_trip_one_cell(spark):
    clean = C.finalize_trips(C.clean_trips(frame(spark, [trip()]), 2024, 1))
    dem = S.hourly_demand(clean).collect()
    assert len(dem) == 1 and dem[0].rides == 1
    assert str(dem[0].pickup_hour) == "2024-01-10 08:00:00"


def test_empty_input(spark):
    empty = frame(spark, [])
    assert S.hourly_demand(C.finalize_trips(C.clean_trips(empty, 2024, 1))).count() == 0
    s = C.clean_stats(empty, 2024, 1).collect()
    assert len(s) == 1 and s[0].total_records == 0 and s[0].percent_dropped is None


def test_grid_fills_gaps_with_zero(spark):
    rows = [trip("2024-01-10 08:15:00", pu=43), trip("2024-01-10 11:59:00", pu=74)]
    dem = S.hourly_demand(C.finalize_trips(C.clean_trips(frame(spark, rows), 2024, 1)))
    got = {(str(r.pickup_hour)[11:13], r.pickup_location_id): r.rides for r in dem.collect()}
    assert len(got) == 4 * 2 and sum(got.values()) == 2 and got[("09", 43)] == 0


def test_backfill_each_month_own_grid(spark):
    rows = [trip("2023-12-31 22:10:00"), trip("2024-01-01 01:30:00", pu=74)]
    bf = S.backfill(frame(spark, rows)).collect()
    by_month = {}
    for r in bf:
        by_month.setdefault((r.year, r.month), []).append(r)
    assert {k: len(v) for k, v in by_month.items()} == {(2023, 12): 1, (2024, 1): 1}


def test_conform_overflow_raises(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 43, 40000, 2024, 1)],
                               "pickup_hour timestamp_ntz, pickup_location_id int, rides int, "
                               "year int, month int")
    from ridegrid.schemas import TAXI_RIDES
    with pytest.raises(Exception, match="out of range"):
        SV.conform(df, TAXI_RIDES).collect()


def _series(spark, rows, pred=False):
    if pred:
        return spark.createDataFrame(rows, "pickup_location_id int, prediction_datetime "
                                           "timestamp_ntz, predicted_rides int")
    return spark.createDataFrame(rows, "pickup_location_id int, pickup_hour timestamp_ntz, rides int")


def test_metrics_null_cases(spark):
    h = dt.datetime(2024, 1, 1, 5)
    zeros = M.forecast_metrics(M.actual_vs_predicted(
        _series(spark, [(43, h, 0)]), _series(spark, [(43, h, 2)], True))).first()
    assert zeros.mae == 2.0 and zeros.mape is None
    none = M.forecast_metrics(M.actual_vs_predicted(
        _series(spark, [(43, h, 1)]), _series(spark, [(43, h + dt.timedelta(hours=1), 2)], True)
    )).first()
    assert none.mae is None and none.mape is None and none.n_pairs == 0
    ok = M.forecast_metrics(M.actual_vs_predicted(
        _series(spark, [(43, h, 4), (43, h + dt.timedelta(hours=1), 0)]),
        _series(spark, [(43, h, 3), (43, h + dt.timedelta(hours=1), 1)], True))).first()
    assert ok.mae == 1.0 and math.isclose(ok.mape, 25.0)


def test_pair_distinct_keeps_two_counts(spark):
    h = dt.datetime(2024, 1, 13, 12)
    dem = _series(spark, [(43, h, 3), (43, h, 5), (43, h, 3)])
    pred = _series(spark, [], True)
    actual, _ = Q.location_week(dem, pred, "2025-01-12 15:20:00", location=43)
    assert sorted(r.rides for r in actual.collect()) == [3, 5]


@pytest.mark.parametrize("anchor,start,end", [
    ("2025-01-12 15:20:00", "2024-01-13 10:00:00", "2024-01-20 11:00:00"),  # off the hour
    ("2025-01-12 15:00:00", "2024-01-13 10:00:00", "2024-01-20 10:00:00"),  # on the hour
    ("2025-03-10 03:30:00", "2024-03-09 23:00:00", "2024-03-17 00:00:00"),  # EDT (UTC-4) since 03-09
])
def test_week_window(spark, anchor, start, end):
    s, e = Q.week_window(anchor)
    got = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (str(got.s), str(got.e)) == (start, end)


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00", "5", "1.5", "abc", "1999", ""),
         ("2024-01-02 06:00:00", "12", "", "x", "2001", "")],
        "t string, i string, d string, s string, y string, e string")
    out = TY.infer_column_types(df)
    assert dict(out.dtypes) == {"t": "timestamp_ntz", "i": "bigint", "d": "double", "s": "string",
                                "y": "bigint", "e": "timestamp_ntz"}
    r = out.orderBy("t").collect()
    assert r[1].d is None and r[0].e is None and r[1].i == 12


def test_prediction_time_from_parts(spark):
    df = spark.createDataFrame([(43, 2024, 1, 5, 3, 7)],
                               "pickup_location_id int, year int, month int, day int, hour int, "
                               "predicted_rides int")
    r = SV.load_predictions(df).first()
    assert str(r.prediction_datetime) == "2024-01-05 03:00:00" and r.predicted_rides == 7
    assert SV.load_predictions(df).dtypes[0] == ("pickup_location_id", "smallint")


def test_insert_if_absent_idempotent(spark):
    h = dt.datetime(2024, 1, 1)
    target = _series(spark, [(43, h, 1)])
    new = _series(spark, [(43, h, 9), (74, h, 2)])
    once = SV.insert_if_absent(target, new, "pickup_location_id")
    twice = SV.insert_if_absent(once, new, "pickup_location_id")
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())
    assert once.count() == 2


def test_lag_is_by_hours_not_rows(spark):
    h = dt.datetime(2024, 1, 1)
    # a gap: hour 2 is missing, so lag_1 of hour 3 must be null, not hour 1's value
    rows = [(43, h, 1), (43, h + dt.timedelta(hours=1), 2), (43, h + dt.timedelta(hours=3), 4)]
    from ridegrid.operators.features import lag_features
    got = {r.pickup_hour.hour: r.lag_1 for r in lag_features(_series(spark, rows)).collect()}
    assert got == {0: None, 1: 1, 3: None}


def test_exact_quantile_matches_brute_force(spark):
    import random
    from ridegrid.operators.clean import exact_quantile
    rnd = random.Random(3)
    rows = [(g, float(rnd.randint(0, 500))) for g in (1, 2) for _ in range(3000)]
    rows += [(1, 7.0)] * 1000 + [(2, float("nan"))] * 10 + [(2, None)] * 5  # a hot value, NaN, null
    df = spark.createDataFrame(rows, "g int, x double")
    for p in (0.0, 0.25, 0.5, 0.999, 1.0):
        got = {r.g: r.q for r in exact_quantile(df, "x", p, ["g"], "q").collect()}
        for g in (1, 2):
            vals = sorted(x for gg, x in rows if gg == g and x is not None and x == x)
            pos = p * (len(vals) - 1)
            lo, hi = vals[int(math.floor(pos))], vals[int(math.ceil(pos))]
            assert math.isclose(got[g], lo + (pos - math.floor(pos)) * (hi - lo)), (p, g)


def test_inert_bounds_equal_the_general_path(spark):
    """At p=0.999, rel_err=0.01 the NaN-check path keeps exactly what the bounds keep."""
    rows = [trip(dist=float("nan")), trip(amount=float("nan")), trip(seconds=5000),
            trip(amount=400.0), trip(dist=30.0), trip(), trip(pax=3.0, dist=0.5)]
    df = frame(spark, rows)
    assert C.bounds_are_inert() and not C.bounds_are_inert(p=0.5)
    fast = C.clean_trips(df, 2024, 1)
    general = C.clean_trips(df, 2024, 1, bounds=C.month_bounds(df, 2024, 1))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, fast.collect())) == sorted(map(key, general.collect()))
    assert fast.count() == 5
    s_fast = C.clean_stats(df, 2024, 1).first().asDict()
    s_gen = C.clean_stats(df, 2024, 1, bounds=C.month_bounds(df, 2024, 1)).first().asDict()
    assert s_fast == s_gen
