"""Exact quantiles by bracketing and mergeable month sketches, against sorted values."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF01
from ridegrid import fixtures as fx
from ridegrid.operators import clean as C
from ridegrid.operators import quantiles as Q
from ridegrid.session import scratch_path
from ridegrid.sources import lake as L


def rows():
    rng = random.Random(6)
    out = [("even", float(i), float(i % 7)) for i in range(700)]
    out += [("hot", 5.0 if i % 3 else rng.random() * 10, rng.choice([1.0, None, math.nan])) for i in range(600)]
    out += [("one", 4.0, None), (None, 1.0, 2.0), (None, 3.0, None), ("none", None, math.nan), ("inf", math.inf, -math.inf), ("inf", 1.0, 0.0)]
    return out


ROWS = rows()


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "g string, x double, y double")


def plain(group, column, p):
    v = sorted(r[column] for r in ROWS if r[0] == group and r[column] is not None and not math.isnan(r[column]))
    if not v:
        return None
    at = p * (len(v) - 1)
    low, high = v[math.floor(at)], v[math.ceil(at)]
    return low if low == high else low + (at - math.floor(at)) * (high - low)


@pytest.mark.parametrize("p, select_rows", [(0.5, 10**6), (0.999, 10**6), (0.37, 3), (0.0, 3), (1.0, 3)])
def test_exact_quantiles(spark, frame, p, select_rows):
    got = {r["g"]: (r["qx"], r["qy"]) for r in Q.exact_quantiles(frame, {"qx": "x", "qy": "y"}, p, ["g"], select_rows).collect()}
    assert set(got) == {r[0] for r in ROWS}
    for g, (qx, qy) in got.items():
        for have, column in ((qx, 1), (qy, 2)):
            want = plain(g, column, p)
            assert (have is None) == (want is None) and (want is None or have == pytest.approx(want, nan_ok=True)), (g, column)


def test_no_groups_and_no_rows(spark, frame):
    got = Q.exact_quantiles(frame.where("g = 'even'"), {"q": "x"}, 0.5, []).collect()
    assert [r["q"] for r in got] == [349.5]
    assert Q.exact_quantiles(frame.limit(0), {"q": "x"}, 0.5, ["g"]).collect() == []


def test_shuffles_carry_few_rows(spark):
    n = 400_000
    df = spark.range(n).select(F.lit(1).alias("g"), (F.col("id") * 7919 % n).cast("double").alias("_q0"))
    known = Q.brackets(df, ["_q0"], 0.999, ["g"])
    held = Q.candidates(df, known, ["_q0"], ["g"])
    assert held.count() < n / 500  # of the rows, these are grouped by value; all else are one row a task
    plan = held._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # the one exchange is above the filter on the bracket (a plan prints from the top) and a partial count
    assert len(shuffled) == 1 and plan.index("Exchange hashpartitioning") < plan.index("Filter")
    assert plan.count("HashAggregate") == 2
    assert Q.exact_quantiles(df, {"q": "_q0"}, 0.999, ["g"]).first()["q"] == pytest.approx(0.999 * (n - 1))


@pytest.fixture(scope="module")
def prepared(spark):
    return C._prepared(C.assign_landing_month(fx.trips(spark, SF01)), None, None)


MEASURES = {b: c for c, b in C.BOUNDED.items()}


def test_sketches_merge_without_trips_and_a_month_can_be_replaced(spark, prepared):
    path = scratch_path(spark, "sketches")
    L.write_partitioned(Q.month_sketches(prepared, MEASURES, C.KEYS, 0.001), path)
    stored = spark.read.parquet(path)
    merged = Q.merged_quantiles(stored, list(MEASURES), 0.9)
    assert "events.parquet" not in merged._jdf.queryExecution().executedPlan().toString()
    worst = Q.rank_errors(prepared, MEASURES, merged, 0.9).collect()
    assert len(worst) == 3 and all(r["rank_error"] <= 0.001 for r in worst)
    # a rebuilt month replaces its own sketch only
    halved = prepared.where("year = 2024 and total_amount < 100")
    L.write_partitioned(Q.month_sketches(halved, MEASURES, C.KEYS, 0.001), path)
    now = prepared.where("year <> 2024").unionByName(halved)
    again = Q.rank_errors(now, MEASURES, Q.merged_quantiles(spark.read.parquet(path), list(MEASURES), 0.9), 0.9).collect()
    assert all(r["rank_error"] <= 0.001 for r in again) and {r["n"] for r in again} != {r["n"] for r in worst}


def test_bounds_from_sketches_clean_the_trips(spark, prepared):
    sketches = Q.month_sketches(prepared, MEASURES, C.KEYS, 0.001)
    bounds = Q.merged_quantiles(sketches, list(MEASURES), 0.9, C.KEYS).select(*C.KEYS, *MEASURES)
    kept = C.clean_trips(C.assign_landing_month(fx.trips(spark, SF01)), bounds=bounds)
    full = C.clean_trips(C.assign_landing_month(fx.trips(spark, SF01)))
    assert 0.6 * full.count() < kept.count() < 0.95 * full.count()


def test_sketches_of_nothing(spark, frame):
    some = Q.month_sketches(frame.where("g = 'none' or g = 'one'"), {"x": "x", "y": "y"}, ["g"])
    got = {r["g"]: (r["x"], r["y"]) for r in Q.merged_quantiles(some, ["x", "y"], 0.5, ["g"]).collect()}
    assert got == {"none": (None, None), "one": (4.0, None)}
    assert Q.merged_quantiles(some.limit(0), ["x"], 0.5).first()["x"] is None


def test_sketch_size_follows_the_error():
    assert Q.sketch_size(0.0133) <= 320 and Q.sketch_size(0.001) > Q.sketch_size(0.01) and Q.sketch_size(1e-9) == 65535
    assert np.isclose(2.296 / Q.sketch_size(0.001) ** 0.9021, 0.001, rtol=0.01)
