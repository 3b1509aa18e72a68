"""The spectrum of hourly series against direct sums and planted rhythms."""
import datetime as dt
import math

import pytest

from ridegrid.operators import spectrum as SP

START = dt.datetime(2024, 1, 1)
SCHEMA = "pickup_hour timestamp_ntz, pickup_location_id int, rides double"


def hour(i):
    return START + dt.timedelta(hours=i)


@pytest.fixture(scope="module")
def series(spark):
    rows = []
    for i in range(240):
        daily = 20 * math.cos(2 * math.pi * i / 24) + 5 * math.sin(2 * math.pi * i / 60)
        rows.append((hour(i), 7, 50 + daily))
        if not 90 <= i < 100:
            rows += [(hour(i), 8, float(i % 7)), (hour(i), 8, 1.0)]  # a gap, two rows an hour
        rows.append((hour(i), None, float((i * i) % 11)))
        rows.append((hour(i), 9, 4.0))
    rows += [(hour(3), 10, 5.0), (None, 7, 900.0), (hour(0), 11, None), (hour(9), 11, None), (hour(240), 8, None)]
    return spark.createDataFrame(rows, SCHEMA)


def direct(values):
    """(cos, sin) sums of every frequency; ``values`` holds None where an hour is missing."""
    known = [v for v in values if v is not None]
    mean, n = sum(known) / len(known), len(values)
    x = [0 if v is None else v - mean for v in values]
    return [tuple(sum(v * f(2 * math.pi * (k * t % n) / n) for t, v in enumerate(x)) for f in (math.cos, math.sin))
            for k in range(1, n // 2 + 1)]


def test_every_frequency_equals_the_direct_sums(series):
    got = {}
    for r in SP.spectrum(series).collect():
        got.setdefault(r["pickup_location_id"], {})[r["k"]] = (r["n_hours"], r["cos_coef"], r["sin_coef"])
    gap = [None if 90 <= i < 100 else i % 7 + 1.0 for i in range(240)] + [None]
    for loc, values in ((8, gap), (None, [float((i * i) % 11) for i in range(240)])):
        want = direct(values)
        assert len(got[loc]) == len(want)
        for k, (c, s) in enumerate(want, 1):
            n, cos, sin = got[loc][k]
            assert n == len(values) and abs(cos - c) < 1e-6 and abs(sin - s) < 1e-6
    assert set(got) == {7, 8, None, 9}  # one hour, or no value: no frequency


def test_planted_rhythms_come_first(series):
    top = SP.dominant_periods(SP.spectrum(series), top=2)
    rows = {(r["pickup_location_id"], r["rank"]): r for r in top.collect()}
    day, sixty = rows[7, 1], rows[7, 2]
    assert (day["period_hours"], day["amplitude"]) == (24.0, 20.0) and (sixty["period_hours"], sixty["amplitude"]) == (60.0, 5.0)
    assert day["first_hour"] == START and str(top.schema["first_hour"].dataType) == "TimestampNTZType()"
    assert day["share"] == round(400 / 425, 4) and sixty["share"] == round(25 / 425, 4)
    assert rows[9, 1]["amplitude"] == 0 and rows[9, 1]["share"] is None and rows[9, 1]["k"] == 1  # constant: ties to k = 1


def test_shares_sum_to_one_and_amplitudes_agree(series):
    spec = SP.spectrum(series)
    shares = {}
    for r in SP.dominant_periods(spec, top=1000).collect():
        shares.setdefault(r["pickup_location_id"], []).append(r["share"])
    assert abs(sum(shares[8]) - 1) < 0.01 and abs(sum(shares[None]) - 1) < 0.01
    amp = {(r["pickup_location_id"], r["k"]): r["amplitude"] for r in SP.amplitudes(spec).collect()}
    assert all(amp[r["pickup_location_id"], r["k"]] == r["amplitude"] for r in SP.dominant_periods(spec).collect())


def test_empty_series(spark, series):
    assert SP.dominant_periods(SP.spectrum(series.limit(0))).count() == 0


def test_short_series_and_uneven_lengths_equal_the_direct_sums(spark):
    lengths = (2, 3, 4, 5, 17, 211, 1000)
    values = {n: [float((i * i * 7 + 3 * i) % 13) for i in range(n)] for n in lengths}
    series = spark.createDataFrame([(hour(i), n, v) for n in lengths for i, v in enumerate(values[n])], SCHEMA)
    spec = SP.spectrum(series)
    plan = spec._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan
    got = {(r["pickup_location_id"], r["k"]): (r["cos_coef"], r["sin_coef"]) for r in spec.collect()}
    want = {(n, k): p for n in lengths for k, p in enumerate(direct(values[n]), 1)}
    assert set(got) == set(want)
    assert all(abs(got[x][0] - c) < 1e-6 and abs(got[x][1] - s) < 1e-6 for x, (c, s) in want.items())
