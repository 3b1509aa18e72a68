import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridegrid.operators import clean as C
from ridegrid.operators import series as S

RAW = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
       "PULocationID int, DOLocationID int, trip_distance double, total_amount double, "
       "fare_amount double, tip_amount double, payment_type int, passenger_count double")
BASE = dt.datetime(2023, 12, 30, 0, 0)

trip = st.tuples(
    st.integers(0, 24 * 5 - 1),        # pickup hour offset: Dec 30 .. Jan 3 (two months)
    st.integers(0, 3599),              # seconds into the hour
    st.integers(-5, 4000),             # duration seconds (some invalid)
    st.sampled_from([1, 43, 74, 132, 264]),
    st.sampled_from([0.0, 1.5, 3.0]),  # distance (0 is dropped)
    st.sampled_from([1.0, 2.5, 12.0]),  # amount (1.0 is dropped)
    st.sampled_from([0.0, 1.0, 5.0, 6.0]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=40))
def test_backfill_grid_invariants(spark, trips):
    rows = []
    for h, s, d, pu, dist, amt, pax in trips:
        p = BASE + dt.timedelta(hours=h, seconds=s)
        rows.append((p, p + dt.timedelta(seconds=d), pu, 1, dist, amt, amt, 0.0, 1, pax))
    raw = spark.createDataFrame(rows, RAW)
    kept = C.clean_trips(C.assign_landing_month(raw))
    dem = S.backfill(raw)
    assert dem.select(F.sum("rides")).first()[0] in (None, kept.count())
    per_month = dem.groupBy("year", "month").agg(
        F.count("*").alias("n"), F.countDistinct("pickup_hour").alias("h"),
        F.countDistinct("pickup_location_id").alias("z")).collect()
    assert all(r.n == r.h * r.z for r in per_month)
    assert dem.count() == dem.select("year", "month", "pickup_hour", "pickup_location_id") \
        .distinct().count()
    # every month's grid spans exactly its first..last observed hour
    spans = kept.groupBy("year", "month").agg(
        F.min("tpep_pickup_datetime").alias("lo"), F.max("tpep_pickup_datetime").alias("hi"))
    for r in spans.collect():
        hours = int((r.hi.replace(minute=0, second=0) - r.lo.replace(minute=0, second=0))
                    .total_seconds() // 3600) + 1
        got = [x.h for x in per_month if (x.year, x.month) == (r.year, r.month)]
        assert got == [hours]
