"""The trend model against known series and separate fits; rolling origins against loops."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridegrid.operators import trend as TR

START = dt.datetime(2024, 1, 1)
SCHEMA = "pickup_hour timestamp_ntz, pickup_location_id int, rides int"


def hours(n):
    return [START + dt.timedelta(hours=i) for i in range(n)]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(4)
    rows = []
    for loc in (7, 43):
        for i, h in enumerate(hours(900)):
            if loc == 43 and 300 <= i < 340:
                continue  # a gap
            value = 50 + 0.1 * i * (loc == 7) + 20 * math.cos(2 * math.pi * h.hour / 24) + 10 * (h.weekday() < 5)
            rows.append((h, loc, int(round(value + rng.normal()))))
    return spark.createDataFrame(rows + [(hours(1)[0], 99, 3), (hours(2)[1], 7, None)], SCHEMA)


def coefs(df):
    return {(r["pickup_location_id"], r["cutoff"]): np.array(r["coefs"]) for r in df.collect()}


def plain_fit(series, loc, cutoff, first, last, model):
    """Ridge least squares of one location with numpy."""
    rows = [r for r in series.collect() if r["pickup_location_id"] == loc and r["rides"] is not None and r["pickup_hour"] < cutoff]
    x, y = [], []
    for r in rows:
        h = int((r["pickup_hour"] - dt.datetime(1970, 1, 1)).total_seconds() // 3600)
        u = (r["pickup_hour"] - first) / (last - first)
        t = [1.0, u] + [max(0.0, u - s) for s in model.bend_points]
        for p, n in model.seasons:
            for k in range(1, n + 1):
                t += [math.cos(2 * math.pi * h * k / p), math.sin(2 * math.pi * h * k / p)]
        x.append(t)
        y.append(r["rides"])
    x, y = np.array(x), np.array(y, dtype=float)
    return np.linalg.solve(x.T @ x + np.diag(model.penalties), x.T @ y)


def test_all_cutoffs_equal_plain_fits(spark, series):
    model = TR.TrendModel(bends=2, seasons=((24, 1), (168, 3)))
    ends = TR.cutoffs(spark, "2024-01-15 00:00:00", 168, 3)
    got = coefs(TR.fit(series, ends, model))
    last = START + dt.timedelta(days=28)
    assert {k[0] for k in got} == {7, 43, 99} and len(got) == 9
    for (loc, cutoff), c in got.items():
        assert np.allclose(c, plain_fit(series, loc, cutoff, START, last, model), atol=1e-6), (loc, cutoff)
    names = TR.coefficients(TR.fit(series, ends, model), model)
    assert names.where("pickup_location_id = 7 and term = 'slope'").count() == 3


def test_forecast_follows_the_series_and_not_the_future(spark, series):
    split = "2024-02-01 00:00:00"
    out = {(r["pickup_location_id"], r["prediction_datetime"]): r for r in TR.trend_forecast(series, split).collect()}
    real = {(r["pickup_location_id"], r["pickup_hour"]): r["rides"] for r in series.collect()}
    cut = dt.datetime(2024, 2, 1)
    assert set(out) == {k for k in real if k[1] >= cut}
    error = np.mean([abs(out[k]["predicted_rides"] - real[k]) for k in out])
    level = np.mean([abs(real[k] - np.mean([v for (loc, h), v in real.items() if loc == k[0] and h < cut and v is not None])) for k in out])
    assert error < 5 and error < level / 3
    changed = series.withColumn("rides", F.when(F.col("pickup_hour") >= F.lit(split).cast("timestamp_ntz"), 0).otherwise(F.col("rides")))
    again = TR.trend_forecast(changed, split).collect()
    assert {(r["pickup_location_id"], r["prediction_datetime"]): r for r in again} == out


def test_a_location_without_history_has_no_fit(spark, series):
    ends = TR.cutoffs(spark, "2024-01-08 00:00:00", 24, 1)
    late = series.where("pickup_location_id <> 7 or pickup_hour >= timestamp_ntz '2024-01-20 00:00:00'")
    assert {k[0] for k in coefs(TR.fit(late, ends))} == {43, 99}
    assert TR.fit(series.limit(0), ends).collect() == []
    assert TR.trend_forecast(series.limit(0), "2024-01-08 00:00:00").collect() == []


def test_horizons_and_seasonal_naive(spark, series):
    ends = TR.cutoffs(spark, "2024-01-20 05:00:00", 31, 4)
    marks = [r["cutoff"] for r in ends.collect()]
    rows = [(r["pickup_location_id"], r["pickup_hour"], r["rides"]) for r in series.collect()]
    for ahead in (24, 200):
        got = TR.horizons(series, ends, ahead)
        want = sorted((loc, h, c, int((h - c) / dt.timedelta(hours=1)) + 1) for loc, h, _ in rows for c in marks
                      if c <= h < c + dt.timedelta(hours=ahead))
        assert sorted((r["pickup_location_id"], r["pickup_hour"], r["cutoff"], r["horizon"]) for r in got.collect()) == want
        assert "CartesianProduct" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    known = {(loc, h): v for loc, h, v in rows if v is not None}
    for r in TR.seasonal_naive(TR.horizons(series, ends, 200), series).collect():
        back = r["pickup_hour"]
        while back >= r["cutoff"]:
            back -= dt.timedelta(hours=168)
        assert r["predicted_rides"] == known[r["pickup_location_id"], back]


def test_errors_by_horizon(spark):
    pairs = spark.createDataFrame([(1, 4, 2), (24, 0, 1), (25, 10, 5), (48, 2, 2)], "horizon int, rides int, predicted_rides int")
    got = {r["horizon_unit"]: (r["mae"], r["mape"], r["n_pairs"]) for r in TR.errors_by_horizon(pairs).collect()}
    assert got == {1: (1.5, 50.0, 2), 2: (2.5, 25.0, 2)}


def test_fit_reads_the_series_for_all_cutoffs_at_once(spark, series, tmp_path):
    path = str(tmp_path / "series")
    series.write.parquet(path)
    stored = spark.read.parquet(path)
    plans = [TR.fit(stored, TR.cutoffs(spark, "2024-01-15 00:00:00", 24, n))._jdf.queryExecution().executedPlan().toString()
             for n in (1, 12)]
    assert plans[0].count("FileScan") == plans[1].count("FileScan") and "Python" not in plans[1]
