"""Registered queries: one per operator of the inventory, with its oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame over the shared test
tables (through the ``trips`` / ``demand`` / ``predictions`` views derived from
``events``).  Scan and sink queries first write their input to a fresh folder
under the shared checkpoint root and return what is read back.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.time import format_hour
from ..operators import clean as C
from ..operators import features as FE
from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators import quantiles as QN
from ..operators import series as S
from ..operators import spectrum as SP
from ..operators import trend as TR
from ..schemas import PREDICTED_RIDES, RAW_PICKUP, TAXI_RIDES
from ..session import scratch_path
from ..sources import compact as CP
from ..sources import lake as L
from ..sources import manifest as MF
from ..sources import serve as SV
from ..sources import typing as TY
from . import served as Q
from .monthly_job import run_backfill, run_changed
from .oracle import CTES, sql

Y, MO = fx.FIXTURE_YEAR, fx.FIXTURE_MONTH
RAW_COLS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
            "trip_distance", "total_amount", "fare_amount", "tip_amount", "payment_type",
            "passenger_count"]
JAN_START, JAN_END = "2024-01-01 00:00:00", "2024-01-31 23:59:59"
# Fixed anchor -> window 2024-01-13 10:00 .. 2024-01-20 11:00 (New York wall clock).
WEEK_START, WEEK_END = "2024-01-13 10:00:00", "2024-01-20 11:00:00"
FORECAST_SPLIT = "2024-01-24 00:00:00"
SKETCH_P, SKETCH_ERROR = 0.95, 0.001

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _trips(spark, sf):
    return fx.trips(spark, sf)


def _prepared(spark, sf):
    return C._prepared(_trips(spark, sf), Y, MO)


def _final(spark, sf, keep_keys=False):
    return C.finalize_trips(C.clean_trips(_trips(spark, sf), Y, MO), keep_keys=keep_keys)


def _counts(spark, sf):
    return S.hourly_rides(_final(spark, sf), keys=[])


def _round(df: DataFrame, cols: list[str], n: int = 4) -> DataFrame:
    return df.select(*[F.round(F.col(c), n).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ------------------------------------------------------------ cleaning (F, P, A4, A6, C1, C2)
@register("trips_not_null", sql("SELECT * FROM not_null", "not_null"))
def trips_not_null(spark, sf):
    return C.filter_not_null(_trips(spark, sf))


@register("trips_in_month", sql("SELECT * FROM not_null WHERE tpep_pickup_datetime >= "
                                "TIMESTAMP '2024-01-01 00:00:00' AND tpep_pickup_datetime < "
                                "TIMESTAMP '2024-02-01 00:00:00'", "not_null"))
def trips_in_month(spark, sf):
    return C.filter_in_month(C.filter_not_null(_trips(spark, sf)), Y, MO)


@register("trips_duration", sql("SELECT * FROM prepared", "prepared"))
def trips_duration(spark, sf):
    return _prepared(spark, sf).select(*RAW_COLS, "duration")


@register("upper_bounds", sql("SELECT 2024 AS year, 1 AS month, * FROM qbounds", "qbounds"))
def upper_bounds(spark, sf):
    return C.upper_bounds(_prepared(spark, sf))


@register("upper_bounds_exact", sql("""
SELECT 2024 AS year, 1 AS month,
       quantile_cont(CAST(duration AS DOUBLE), 0.999) AS max_duration,
       quantile_cont(total_amount, 0.999) FILTER (WHERE NOT isnan(total_amount)) AS max_total_amount,
       quantile_cont(trip_distance, 0.999) FILTER (WHERE NOT isnan(trip_distance)) AS max_distance
FROM prepared""", "prepared"))
def upper_bounds_exact(spark, sf):
    return C.upper_bounds_exact(_prepared(spark, sf))


@register("trips_range_filters", sql("""
SELECT prepared.* FROM prepared, qbounds
WHERE duration > 0 AND duration <= max_duration
  AND total_amount >= 2.5 AND total_amount <= max_total_amount
  AND trip_distance > 0 AND trip_distance <= max_distance""", "prepared", "qbounds"))
def trips_range_filters(spark, sf):
    prepared = _prepared(spark, sf)
    bounds = C.upper_bounds(prepared)
    return (prepared.join(F.broadcast(bounds), C.KEYS)
            .where(C.duration_ok() & C.amount_ok() & C.distance_ok())
            .select(*RAW_COLS, "duration"))


@register("trips_known_locations",
          sql("SELECT * FROM trips WHERE PULocationID NOT IN (1, 264, 265)", "trips"))
def trips_known_locations(spark, sf):
    return _trips(spark, sf).where(C.location_ok())


@register("trips_passengers",
          sql("SELECT * FROM trips WHERE passenger_count BETWEEN 1 AND 5", "trips"))
def trips_passengers(spark, sf):
    return _trips(spark, sf).where(C.passengers_ok())


@register("trips_filtered", sql("SELECT * FROM filtered", "filtered"))
def trips_filtered(spark, sf):
    return C.clean_trips(_trips(spark, sf), Y, MO).select(*RAW_COLS, "duration")


@register("trips_final", sql("SELECT * FROM final", "final"))
def trips_final(spark, sf):
    return _final(spark, sf)


_STATS_SQL = sql("""
SELECT 2024 AS year, 1 AS month,
  (SELECT count(*) FROM trips) AS total_records,
  (SELECT count(*) FROM s7) AS valid_records,
  (SELECT count(*) FROM trips) - (SELECT count(*) FROM s7) AS records_dropped,
  round(CAST((SELECT count(*) FROM trips) - (SELECT count(*) FROM s7) AS DOUBLE) * 100
        / (SELECT count(*) FROM trips), 2) AS percent_dropped,
  (SELECT count(*) FROM trips) - (SELECT count(*) FROM not_null) AS dropped_missing,
  (SELECT count(*) FROM not_null) - (SELECT count(*) FROM prepared) AS dropped_date_range,
  (SELECT count(*) FROM prepared) - (SELECT count(*) FROM s3) AS dropped_duration,
  (SELECT count(*) FROM s3) - (SELECT count(*) FROM s4) AS dropped_total_amount,
  (SELECT count(*) FROM s4) - (SELECT count(*) FROM s5) AS dropped_distance,
  (SELECT count(*) FROM s5) - (SELECT count(*) FROM s6) AS dropped_location,
  (SELECT count(*) FROM s6) - (SELECT count(*) FROM s7) AS dropped_passenger_count
""", "prepared", "qbounds", extra={
    "s3": "SELECT p.* FROM prepared p, qbounds b WHERE duration > 0 AND duration <= b.max_duration",
    "s4": "SELECT s.* FROM s3 s, qbounds b WHERE total_amount >= 2.5 "
          "AND total_amount <= b.max_total_amount",
    "s5": "SELECT s.* FROM s4 s, qbounds b WHERE trip_distance > 0 "
          "AND trip_distance <= b.max_distance",
    "s6": "SELECT * FROM s5 WHERE PULocationID NOT IN (1, 264, 265)",
    "s7": "SELECT * FROM s6 WHERE passenger_count >= 1 AND passenger_count <= 5",
})


@register("clean_stats", _STATS_SQL)
def clean_stats(spark, sf):
    return C.clean_stats(_trips(spark, sf), Y, MO)


# ------------------------------------------------------------ series
@register("hourly_rides", sql("SELECT * FROM counts", "counts"))
def hourly_rides(spark, sf):
    return _counts(spark, sf)


@register("hour_bounds", sql("""
SELECT lo AS first_hour, hi AS last_hour, CAST(date_diff('hour', lo, hi) + 1 AS BIGINT) AS n_hours
FROM hbounds""", "hbounds"))
def hour_bounds(spark, sf):
    return S.hour_bounds(_counts(spark, sf), keys=[])


@register("distinct_locations", sql("SELECT DISTINCT pickup_location_id FROM counts", "counts"))
def distinct_locations(spark, sf):
    return S.distinct_locations(_counts(spark, sf), keys=[])


@register("hour_location_grid", sql("SELECT * FROM grid", "grid"))
def hour_location_grid(spark, sf):
    return S.hour_location_grid(_counts(spark, sf), keys=[])


@register("demand_filled", sql("SELECT * FROM demand", "demand"))
def demand_filled(spark, sf):
    return fx.demand(spark, sf)


_BACKFILL_CTES = {
    "bprep": f"""
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
       CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)
       - CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT) AS duration
FROM not_null""",
    "bq": """
SELECT year, month, max(CAST(duration AS DOUBLE)) AS max_duration,
       max(total_amount) FILTER (WHERE NOT isnan(total_amount)) AS max_total_amount,
       max(trip_distance) FILTER (WHERE NOT isnan(trip_distance)) AS max_distance
FROM bprep GROUP BY year, month""",
    "bclean": """
SELECT p.year, p.month, p.tpep_pickup_datetime AS pickup_datetime,
       CAST(p.PULocationID AS INTEGER) AS pickup_location_id
FROM bprep p JOIN bq q ON p.year = q.year AND p.month = q.month
WHERE duration > 0 AND duration <= max_duration
  AND total_amount >= 2.5 AND total_amount <= max_total_amount
  AND trip_distance > 0 AND trip_distance <= max_distance
  AND PULocationID NOT IN (1, 264, 265) AND passenger_count >= 1 AND passenger_count <= 5""",
    "bcounts": """
SELECT year, month, date_trunc('hour', pickup_datetime) AS pickup_hour, pickup_location_id,
       count(*) AS rides
FROM bclean GROUP BY ALL""",
    "bgrid": """
SELECT b.year, b.month, unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS pickup_hour,
       l.pickup_location_id
FROM (SELECT year, month, min(pickup_hour) AS lo, max(pickup_hour) AS hi
      FROM bcounts GROUP BY year, month) b
JOIN (SELECT DISTINCT year, month, pickup_location_id FROM bcounts) l
  ON b.year = l.year AND b.month = l.month""",
    "bdemand": """
SELECT g.year, g.month, g.pickup_hour, g.pickup_location_id,
       CAST(coalesce(c.rides, 0) AS INTEGER) AS rides
FROM bgrid g LEFT JOIN bcounts c
  ON g.year = c.year AND g.month = c.month AND g.pickup_hour = c.pickup_hour
 AND g.pickup_location_id = c.pickup_location_id""",
}


def _bsql(body: str) -> str:
    return sql(body, "not_null", extra=_BACKFILL_CTES)


#: The names of the one-month oracles over every month of the trips.
_MONTHS_CTES = {**_BACKFILL_CTES, "filtered": """
SELECT p.* FROM bprep p JOIN bq q ON p.year = q.year AND p.month = q.month
WHERE duration > 0 AND duration <= max_duration
  AND total_amount >= 2.5 AND total_amount <= max_total_amount
  AND trip_distance > 0 AND trip_distance <= max_distance
  AND PULocationID NOT IN (1, 264, 265) AND passenger_count >= 1 AND passenger_count <= 5""",
                "final": CTES["final"][1],
                "demand": "SELECT pickup_hour, pickup_location_id, rides FROM bdemand",
                "predictions": CTES["predictions"][1], "pairs": CTES["pairs"][1]}


def _msql(body: str, **extra: str) -> str:
    """``demand``, ``final``, ``predictions`` and ``pairs`` over all months, then ``body``."""
    return sql(body, "not_null", extra={**_MONTHS_CTES, **extra})


def _all_trips(spark, sf):
    return C.finalize_trips(C.clean_trips(C.assign_landing_month(_trips(spark, sf))), keep_keys=False)


def _all_demand(spark, sf):
    return S.backfill(_trips(spark, sf)).select("pickup_hour", "pickup_location_id", "rides")


@register("backfill_demand", _bsql("SELECT * FROM bdemand"))
def backfill_demand(spark, sf):
    return S.backfill(_trips(spark, sf))


_BSTATS = _bsql("""
SELECT year, month, count(*) AS total_records,
       count(*) FILTER (WHERE stage IS NULL) AS valid_records,
       count(*) FILTER (WHERE stage IS NOT NULL) AS records_dropped,
       round(CAST(count(*) FILTER (WHERE stage IS NOT NULL) AS DOUBLE) * 100 / count(*), 2)
         AS percent_dropped,
       count(*) FILTER (WHERE stage = 'missing') AS dropped_missing,
       count(*) FILTER (WHERE stage = 'date_range') AS dropped_date_range,
       count(*) FILTER (WHERE stage = 'duration') AS dropped_duration,
       count(*) FILTER (WHERE stage = 'total_amount') AS dropped_total_amount,
       count(*) FILTER (WHERE stage = 'distance') AS dropped_distance,
       count(*) FILTER (WHERE stage = 'location') AS dropped_location,
       count(*) FILTER (WHERE stage = 'passenger_count') AS dropped_passenger_count
FROM btagged GROUP BY year, month""")
_BSTATS = _BSTATS.replace("\nSELECT year, month, count(*) AS total_records", """,
btagged AS (
SELECT t.year, t.month,
  CASE WHEN tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL OR total_amount IS NULL
            OR PULocationID IS NULL OR DOLocationID IS NULL OR trip_distance IS NULL
            OR passenger_count IS NULL THEN 'missing'
       WHEN NOT coalesce(tpep_pickup_datetime >= make_timestamp(t.year, t.month, 1, 0, 0, 0)
                AND tpep_pickup_datetime < make_timestamp(t.year, t.month, 1, 0, 0, 0)
                                           + INTERVAL 1 MONTH, false) THEN 'date_range'
       WHEN NOT coalesce(duration > 0 AND duration <= q.max_duration, false) THEN 'duration'
       WHEN NOT coalesce(total_amount >= 2.5 AND total_amount <= q.max_total_amount, false)
            THEN 'total_amount'
       WHEN NOT coalesce(trip_distance > 0 AND trip_distance <= q.max_distance, false)
            THEN 'distance'
       WHEN NOT coalesce(PULocationID NOT IN (1, 264, 265), false) THEN 'location'
       WHEN NOT coalesce(passenger_count >= 1 AND passenger_count <= 5, false)
            THEN 'passenger_count'
  END AS stage
FROM (SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
             CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
             CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)
             - CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT) AS duration
      FROM trips) t
LEFT JOIN bq q ON t.year = q.year AND t.month = q.month)
SELECT year, month, count(*) AS total_records""", 1)


@register("backfill_stats", _BSTATS)
def backfill_stats(spark, sf):
    return C.clean_stats(C.assign_landing_month(_trips(spark, sf)))


@register("upper_bounds_exact_months", _bsql("""
SELECT year, month, quantile_cont(CAST(duration AS DOUBLE), 0.99) AS max_duration,
       quantile_cont(total_amount, 0.99) FILTER (WHERE NOT isnan(total_amount)) AS max_total_amount,
       quantile_cont(trip_distance, 0.99) FILTER (WHERE NOT isnan(trip_distance)) AS max_distance
FROM bprep GROUP BY year, month"""))
def upper_bounds_exact_months(spark, sf):
    """Exact bounds of every landing month, bracketed in the same passes."""
    return C.upper_bounds_exact(C._prepared(C.assign_landing_month(_trips(spark, sf)), None, None), p=0.99)


_MEASURES = "(VALUES ('max_duration', CAST(duration AS DOUBLE)), ('max_total_amount', total_amount), ('max_distance', trip_distance))"


@register("upper_bounds_sketch", _bsql(f"""
SELECT g.year, measure, count(v) AS n, true AS within_error
FROM (SELECT * FROM bprep, (SELECT NULL AS y UNION ALL SELECT 1) s(y)) b,
  LATERAL (SELECT CASE WHEN b.y IS NULL THEN NULL ELSE b.year END AS year) g, LATERAL {_MEASURES} m(measure, v)
WHERE NOT isnan(v) GROUP BY g.year, measure"""))
def upper_bounds_sketch(spark, sf):
    """Months' stored sketches, merged per year and over all (null year) without the trips; then judged by the trips."""
    path = scratch_path(spark, "month-sketches")
    prepared = C._prepared(C.assign_landing_month(_trips(spark, sf)), None, None)
    measures = {b: c for c, b in C.BOUNDED.items()}
    L.write_partitioned(QN.month_sketches(prepared, measures, C.KEYS, SKETCH_ERROR), path)
    stored = spark.read.parquet(path)
    parts = []
    for by in (["year"], []):
        bounds = QN.merged_quantiles(stored, list(measures), SKETCH_P, by)
        parts.append(QN.rank_errors(prepared, measures, bounds, SKETCH_P, by))
    judged = parts[0].unionByName(parts[1].withColumn("year", F.lit(None).cast("int")))
    return judged.select("year", "measure", "n", (F.col("rank_error") <= SKETCH_ERROR).alias("within_error"))


_SERVED_DEMAND = _bsql("""
SELECT CAST(pickup_hour AS TIMESTAMP) AS pickup_hour,
       CAST(pickup_location_id AS SMALLINT) AS pickup_location_id,
       CAST(rides AS SMALLINT) AS rides, year, month
FROM bdemand""")


@register("backfill_mixed_types", _SERVED_DEMAND)
def backfill_mixed_types(spark, sf):
    """The demand layer that the many-month job writes from months of different physical types."""
    base = scratch_path(spark, "mixed-lake")
    fx.write_mixed_lake(spark, sf, f"{base}/raw")
    run_backfill(spark, f"{base}/raw", f"{base}/clean", f"{base}/demand")
    return L.read_demand(spark, f"{base}/demand")


# ------------------------------------------------------------ scans and sinks (S, K, U1)
@register("scan_month_trips", sql("""
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
FROM trips WHERE year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = 1""",
                                  "trips"))
def scan_month_trips(spark, sf):
    base = scratch_path(spark, "raw-lake")
    L.write_partitioned(C.assign_landing_month(_trips(spark, sf)), base,
                        sort_by=["PULocationID", RAW_PICKUP])
    return L.read_trips(spark, base, Y, MO)


@register("scan_demand_years", _bsql("""
SELECT CAST(pickup_hour AS TIMESTAMP) AS pickup_hour,
       CAST(pickup_location_id AS SMALLINT) AS pickup_location_id,
       CAST(rides AS SMALLINT) AS rides, year, month
FROM bdemand WHERE year = 2024"""))
def scan_demand_years(spark, sf):
    base = scratch_path(spark, "demand-lake")
    L.write_demand(S.backfill(_trips(spark, sf)), base)
    return L.read_demand(spark, base, [2024])


@register("scan_predictions_csv", sql("""
SELECT prediction_datetime, predicted_rides, pickup_location_id,
       CAST(year(prediction_datetime) AS INTEGER) AS year,
       CAST(month(prediction_datetime) AS INTEGER) AS month,
       CAST(day(prediction_datetime) AS INTEGER) AS day,
       CAST(hour(prediction_datetime) AS INTEGER) AS hour
FROM predictions""", "predictions"))
def scan_predictions_csv(spark, sf):
    base = scratch_path(spark, "predictions-csv")
    L.write_predictions(fx.predictions(spark, sf), base)
    return L.read_predictions(spark, base, [2024], L.PREDICTION_PARTS)


@register("compact_predictions", ORACLE["scan_predictions_csv"])
def compact_predictions(spark, sf):
    """The prediction files of ``scan_predictions_csv``, packed into sized Parquet files."""
    base, out = scratch_path(spark, "predictions-csv"), scratch_path(spark, "predictions-packed")
    L.write_predictions(fx.predictions(spark, sf), base)
    return CP.read_compacted(spark, CP.compact_predictions(spark, base, out, [2024], L.PREDICTION_PARTS))


@register("prediction_from_parts", sql("""
SELECT CAST(pickup_location_id AS SMALLINT) AS pickup_location_id, prediction_datetime,
       CAST(predicted_rides AS SMALLINT) AS predicted_rides
FROM predictions""", "predictions"))
def prediction_from_parts(spark, sf):
    # rows as the CSV scan yields them when the file has no time column:
    # only the path keys (location, year, month, day, hour) carry the time
    parts = L.prediction_keys(fx.predictions(spark, sf)).drop("prediction_datetime")
    return SV.load_predictions(parts)


@register("sink_clean_roundtrip", sql("SELECT *, 2024 AS year, 1 AS month FROM final", "final"))
def sink_clean_roundtrip(spark, sf):
    base = scratch_path(spark, "clean-lake")
    clean = _final(spark, sf, keep_keys=True)
    L.write_clean_trips(clean, base)
    L.write_clean_trips(clean, base)  # a rerun replaces the month, it does not duplicate it
    return spark.read.parquet(base)


@register("sink_demand_roundtrip", sql("""
SELECT CAST(pickup_hour AS TIMESTAMP) AS pickup_hour,
       CAST(pickup_location_id AS SMALLINT) AS pickup_location_id,
       CAST(rides AS SMALLINT) AS rides, 2024 AS year, 1 AS month
FROM demand""", "demand"))
def sink_demand_roundtrip(spark, sf):
    base = scratch_path(spark, "demand-sink")
    dem = S.hourly_demand(_final(spark, sf, keep_keys=True))
    L.write_demand(dem, base)
    L.write_demand(dem, base)
    return spark.read.parquet(base)


@register("conform_demand", sql("""
SELECT CAST(pickup_hour AS TIMESTAMP) AS pickup_hour,
       CAST(pickup_location_id AS SMALLINT) AS pickup_location_id,
       CAST(rides AS SMALLINT) AS rides, CAST(2024 AS SMALLINT) AS year,
       CAST(1 AS SMALLINT) AS month
FROM demand""", "demand"))
def conform_demand(spark, sf):
    dem = S.hourly_demand(_final(spark, sf, keep_keys=True))
    return SV.conform(dem, TAXI_RIDES)


@register("serve_replace", _msql("""
SELECT CAST(pickup_location_id AS SMALLINT) AS pickup_location_id, prediction_datetime,
       CAST(predicted_rides AS SMALLINT) AS predicted_rides
FROM predictions"""))
def serve_replace(spark, sf):
    path = scratch_path(spark, "served-predictions")
    pred = fx.predictions_from_demand(_all_demand(spark, sf))
    SV.serve(pred.where(F.col("predicted_rides") > 0), path, "overwrite", PREDICTED_RIDES)
    SV.serve(pred, path, "overwrite", PREDICTED_RIDES)  # replace, not add
    return SV.read_served(spark, path)


@register("serve_append", _msql("SELECT * FROM demand"))
def serve_append(spark, sf):
    path = scratch_path(spark, "served-demand")
    dem = _all_demand(spark, sf)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    SV.serve(dem.where(F.col("pickup_hour") < cut), path, "overwrite")
    SV.serve(dem.where(F.col("pickup_hour") >= cut), path, "append")
    return SV.read_served(spark, path)


@register("missing_months", sql("""
SELECT DISTINCT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
FROM trips WHERE NOT (year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = 1)""",
                                "trips"))
def missing_months(spark, sf):
    base = scratch_path(spark, "landed")
    trips = _trips(spark, sf)
    L.write_clean_trips(_final(spark, sf, keep_keys=True), base)  # only 2024-01 has landed
    requested = C.assign_landing_month(trips).select("year", "month")
    return L.missing_months(requested, L.landed_months(spark, base))


@register("insert_if_absent", _msql("""
SELECT pickup_hour, pickup_location_id, rides FROM demand
UNION ALL
SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, dropoff_location_id AS pickup_location_id,
       CAST(count(*) AS INTEGER) AS rides
FROM final
WHERE dropoff_location_id NOT IN (SELECT DISTINCT pickup_location_id FROM demand)
GROUP BY 1, 2"""))
def insert_if_absent(spark, sf):
    final = _all_trips(spark, sf)
    target = _all_demand(spark, sf)
    by_dropoff = (S.hourly_rides(final, keys=[], loc_col="dropoff_location_id")
                  .withColumn("rides", F.col("rides").cast("int")))
    once = SV.insert_if_absent(target, by_dropoff, "pickup_location_id")
    return SV.insert_if_absent(once, by_dropoff, "pickup_location_id")  # idempotent


@register("union_months", _bsql("""
SELECT year, month, pickup_hour, pickup_location_id, rides FROM bdemand WHERE year = 2024
UNION ALL
SELECT year, NULL AS month, pickup_hour, pickup_location_id, rides FROM bdemand WHERE year = 2023"""))
def union_months(spark, sf):
    bf = S.backfill(_trips(spark, sf))
    newer = bf.where(F.col("year") == 2024)
    older = bf.where(F.col("year") == 2023).drop("month")
    return SV.union_frames([newer, older])


@register("param_query", _msql("""
SELECT pickup_hour, pickup_location_id, rides FROM demand
WHERE pickup_hour BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 23:59:59'
  AND rides >= 1"""))
def param_query(spark, sf):
    return Q.run_query(
        spark,
        "SELECT pickup_hour, pickup_location_id, rides FROM {demand} "
        "WHERE pickup_hour BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ) "
        "AND rides >= :min_rides ORDER BY pickup_hour",
        args={"start": JAN_START, "end": JAN_END, "min_rides": 1},
        demand=_all_demand(spark, sf))


@register("infer_types", _msql("""
SELECT pickup_hour, CAST(pickup_location_id AS BIGINT) AS pickup_location_id,
       CAST(rides AS BIGINT) AS rides
FROM demand"""))
def infer_types(spark, sf):
    return TY.infer_column_types(TY.to_text(_all_demand(spark, sf)))


@register("infer_types_trips", _msql("""
SELECT pickup_datetime, dropoff_datetime,
       CAST(pickup_location_id AS BIGINT) AS pickup_location_id,
       CAST(dropoff_location_id AS BIGINT) AS dropoff_location_id,
       trip_distance, fare_amount, tip_amount,
       CAST(payment_type AS BIGINT) AS payment_type,
       CAST(passenger_count AS BIGINT) AS passenger_count
FROM final"""))
def infer_types_trips(spark, sf):
    return TY.infer_column_types(TY.to_text(_all_trips(spark, sf)))


@register("typed_result", _msql("SELECT * FROM demand"))
def typed_result(spark, sf):
    text = TY.to_text(_all_demand(spark, sf))
    return TY.typed_result(text, {"pickup_hour": "timestamp_ntz", "pickup_location_id": "int",
                                  "rides": "int"})


# ------------------------------------------------------------ served queries (D1-D3, A7, A10-A12, O3, X)
@register("demand_between", _msql(f"""
SELECT * FROM demand
WHERE pickup_hour BETWEEN TIMESTAMP '{JAN_START}' AND TIMESTAMP '{JAN_END}'"""))
def demand_between(spark, sf):
    return Q.demand_range(_all_demand(spark, sf), JAN_START, JAN_END)


@register("location_week_actual", _msql(f"""
SELECT DISTINCT pickup_location_id, pickup_hour, rides FROM demand
WHERE pickup_hour BETWEEN TIMESTAMP '{WEEK_START}' AND TIMESTAMP '{WEEK_END}'"""))
def location_week_actual(spark, sf):
    dem = _all_demand(spark, sf)
    return Q.location_week(dem, fx.predictions_from_demand(dem), fx.WEEK_ANCHOR_UTC)[0]


@register("location_week_predicted", _msql(f"""
SELECT DISTINCT pickup_location_id, prediction_datetime, predicted_rides FROM predictions
WHERE prediction_datetime BETWEEN TIMESTAMP '{WEEK_START}' AND TIMESTAMP '{WEEK_END}'"""))
def location_week_predicted(spark, sf):
    dem = _all_demand(spark, sf)
    return Q.location_week(dem, fx.predictions_from_demand(dem), fx.WEEK_ANCHOR_UTC)[1]


@register("week_window", sql("""
SELECT tpep_pickup_datetime AS anchor,
  date_trunc('hour', timezone('America/New_York', timezone('UTC', tpep_pickup_datetime))
                     - INTERVAL 365 DAY) AS window_start,
  CASE WHEN timezone('America/New_York', timezone('UTC', tpep_pickup_datetime)) - INTERVAL 358 DAY
            > date_trunc('hour', timezone('America/New_York', timezone('UTC', tpep_pickup_datetime))
                                 - INTERVAL 358 DAY)
       THEN date_trunc('hour', timezone('America/New_York', timezone('UTC', tpep_pickup_datetime))
                               - INTERVAL 358 DAY) + INTERVAL 1 HOUR
       ELSE date_trunc('hour', timezone('America/New_York', timezone('UTC', tpep_pickup_datetime))
                               - INTERVAL 358 DAY) END AS window_end
FROM trips""", "trips"))
def week_window(spark, sf):
    start, end = Q.week_window(F.col(RAW_PICKUP))
    return _trips(spark, sf).select(F.col(RAW_PICKUP).alias("anchor"),
                                    start.alias("window_start"), end.alias("window_end"))


@register("format_hour", _msql("""
SELECT pickup_location_id, strftime(pickup_hour, '%Y-%m-%d %H:%M:%S') AS pickup_hour_text
FROM demand"""))
def format_hour_q(spark, sf):
    return _all_demand(spark, sf).select("pickup_location_id",
                                       format_hour("pickup_hour").alias("pickup_hour_text"))


@register("location_series", _msql("""
SELECT pickup_location_id, strftime(pickup_hour, '%Y-%m-%d %H:%M:%S') AS pickup_hour, rides
FROM demand"""))
def location_series(spark, sf):
    dem = _all_demand(spark, sf)
    return Q.location_series(dem, fx.predictions_from_demand(dem))[0]


@register("location_series_predicted", _msql("""
SELECT pickup_location_id,
       strftime(prediction_datetime, '%Y-%m-%d %H:%M:%S') AS prediction_datetime, predicted_rides
FROM predictions"""))
def location_series_predicted(spark, sf):
    dem = _all_demand(spark, sf)
    return Q.location_series(dem, fx.predictions_from_demand(dem))[1]


@register("location_summary", _msql("""
SELECT pickup_location_id, count(*) AS n_rows, min(pickup_hour) AS first_hour,
       max(pickup_hour) AS last_hour, CAST(sum(rides) AS BIGINT) AS total_rides
FROM demand GROUP BY pickup_location_id"""))
def location_summary(spark, sf):
    return Q.location_summary(_all_demand(spark, sf))


_PROFILE_TYPES = [("tpep_pickup_datetime", "timestamp_ntz"), ("tpep_dropoff_datetime", "timestamp_ntz"),
                  ("PULocationID", "int"), ("DOLocationID", "int"), ("trip_distance", "double"),
                  ("total_amount", "double"), ("fare_amount", "double"), ("tip_amount", "double"),
                  ("payment_type", "int"), ("passenger_count", "double")]


@register("column_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM trips"
    for c, t in _PROFILE_TYPES), "trips"))
def column_profile(spark, sf):
    return Q.column_profile(_trips(spark, sf))


@register("first_locations", _msql("""
SELECT DISTINCT pickup_location_id FROM demand ORDER BY pickup_location_id LIMIT 10"""))
def first_locations(spark, sf):
    return Q.first_locations(_all_demand(spark, sf), 10)


@register("demand_by_band", _msql("""
SELECT pickup_location_id,
       CASE WHEN hour(pickup_hour) BETWEEN 7 AND 9 OR hour(pickup_hour) BETWEEN 16 AND 18 THEN 'peak'
            WHEN hour(pickup_hour) BETWEEN 0 AND 5 THEN 'night' ELSE 'regular' END AS hour_band,
       count(*) AS n_hours, CAST(sum(rides) AS BIGINT) AS total_rides
FROM demand GROUP BY 1, 2"""))
def demand_by_band(spark, sf):
    return Q.demand_by_band(_all_demand(spark, sf))


# ------------------------------------------------------------ accuracy
@register("actual_vs_predicted", _msql("SELECT * FROM pairs"))
def actual_vs_predicted(spark, sf):
    dem = _all_demand(spark, sf)
    return M.actual_vs_predicted(dem, fx.predictions_from_demand(dem))


@register("location_names", _msql("""
SELECT p.*, n.location_name FROM pairs p LEFT JOIN
  (VALUES (43, 'Lower East Side'), (74, 'East Harlem'), (132, 'JFK Airport'))
  AS n(pickup_location_id, location_name) ON p.pickup_location_id = n.pickup_location_id"""))
def location_names(spark, sf):
    dem = _all_demand(spark, sf)
    return M.compare(dem, fx.predictions_from_demand(dem))


_METRICS = """round(avg(abs(rides - predicted_rides)), 4) AS mae,
       round(avg(CASE WHEN rides > 0 THEN abs(rides - predicted_rides) / rides END) * 100, 4) AS mape,
       count(*) AS n_pairs"""


@register("forecast_metrics", _msql(f"SELECT {_METRICS} FROM pairs"))
def forecast_metrics(spark, sf):
    dem = _all_demand(spark, sf)
    pairs = M.actual_vs_predicted(dem, fx.predictions_from_demand(dem))
    return _round(M.forecast_metrics(pairs), ["mae", "mape"])


@register("forecast_metrics_by_location",
          _msql(f"SELECT pickup_location_id, {_METRICS} FROM pairs GROUP BY pickup_location_id"))
def forecast_metrics_by_location(spark, sf):
    dem = _all_demand(spark, sf)
    pairs = M.actual_vs_predicted(dem, fx.predictions_from_demand(dem))
    return _round(M.forecast_metrics(pairs, ["pickup_location_id"]), ["mae", "mape"])


# ------------------------------------------------------------ model features (M1-M3)
@register("lag_features", _msql("""
SELECT d.pickup_hour, d.pickup_location_id, d.rides,
       l1.rides AS lag_1, l24.rides AS lag_24, l168.rides AS lag_168
FROM demand d
LEFT JOIN demand l1 ON l1.pickup_location_id = d.pickup_location_id
                   AND l1.pickup_hour = d.pickup_hour - INTERVAL 1 HOUR
LEFT JOIN demand l24 ON l24.pickup_location_id = d.pickup_location_id
                    AND l24.pickup_hour = d.pickup_hour - INTERVAL 24 HOUR
LEFT JOIN demand l168 ON l168.pickup_location_id = d.pickup_location_id
                     AND l168.pickup_hour = d.pickup_hour - INTERVAL 168 HOUR"""))
def lag_features(spark, sf):
    return FE.lag_features(_all_demand(spark, sf))


def _fourier_sql() -> str:
    parts = []
    for p in FE.DEFAULT_PERIODS:
        ang = f"(2 * pi() * (CAST(floor(epoch(pickup_hour) / 3600) AS BIGINT) % {p}) / {p})"
        parts.append(f"""
SELECT pickup_location_id, {p} AS period_hours,
       round(sum(rides * cos({ang})), 4) + CAST(0 AS DOUBLE) AS cos_coef,
       round(sum(rides * sin({ang})), 4) + CAST(0 AS DOUBLE) AS sin_coef,
       round(sqrt(pow(sum(rides * cos({ang})), 2) + pow(sum(rides * sin({ang})), 2)) * 2
             / count(*), 4) + CAST(0 AS DOUBLE) AS amplitude
FROM demand GROUP BY pickup_location_id""")
    return _msql(" UNION ALL ".join(parts))


@register("fourier_features", _fourier_sql())
def fourier_features(spark, sf):
    return FE.fourier_features(_all_demand(spark, sf))


#: Hours from a location's first to its last, centred; every frequency of every location; its summed power.
_SPECTRUM_CTES = {
    "by_hour": """SELECT pickup_location_id AS loc, CAST(floor(epoch(pickup_hour) / 3600) AS BIGINT) AS t, sum(rides) AS x
FROM demand GROUP BY 1, 2""",
    "span": "SELECT loc, min(t) AS t0, max(t) - min(t) + 1 AS n, avg(x) AS m FROM by_hour GROUP BY loc",
    "centred": "SELECT h.loc, s.t0, s.n, h.t - s.t0 AS t, h.x - s.m AS v FROM by_hour h JOIN span s ON h.loc = s.loc",
    "freq": "SELECT loc, unnest(range(1, n // 2 + 1)) AS k FROM span",
    "spec": """SELECT c.loc AS pickup_location_id, make_timestamp(c.t0 * 3600000000) AS first_hour, c.n AS n_hours, f.k,
       sum(v * cos(2 * pi() * ((f.k * t) % c.n) / c.n)) AS cos_coef,
       sum(v * sin(2 * pi() * ((f.k * t) % c.n) / c.n)) AS sin_coef
FROM centred c JOIN freq f ON c.loc = f.loc GROUP BY 1, 2, 3, 4""",
    "powers": """SELECT *, CASE WHEN 2 * k = n_hours THEN 1 ELSE 2 END AS sides,
       (cos_coef * cos_coef + sin_coef * sin_coef) * CASE WHEN 2 * k = n_hours THEN 1 ELSE 2 END / (n_hours * n_hours) AS power
FROM spec"""}


@register("spectrum", _msql("""
SELECT pickup_location_id, first_hour, n_hours, k, round(n_hours / k, 4) AS period_hours,
       round(cos_coef, 4) + CAST(0 AS DOUBLE) AS cos_coef, round(sin_coef, 4) + CAST(0 AS DOUBLE) AS sin_coef,
       round(sqrt(power * sides), 4) AS amplitude
FROM powers""", **_SPECTRUM_CTES))
def spectrum(spark, sf):
    return SP.amplitudes(SP.spectrum(_all_demand(spark, sf)))


@register("dominant_periods", _msql("""
SELECT pickup_location_id, rank, first_hour, n_hours, k, round(n_hours / k, 4) AS period_hours,
       round(sqrt(power * sides), 4) AS amplitude, CASE WHEN round(total, 9) > 0 THEN round(power / total, 4) END AS share
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY pickup_location_id ORDER BY round(power, 6) DESC, k) AS INTEGER) AS rank,
             sum(power) OVER (PARTITION BY pickup_location_id) AS total FROM powers)
WHERE rank <= 5""", **_SPECTRUM_CTES))
def dominant_periods(spark, sf):
    return SP.dominant_periods(SP.spectrum(_all_demand(spark, sf)))


@register("demand_forecast")  # model output: rows-only check
def demand_forecast(spark, sf):
    return FC.demand_forecast(_all_demand(spark, sf), FORECAST_SPLIT)


@register("demand_forecast_keys", _msql(f"""
SELECT pickup_location_id, pickup_hour AS prediction_datetime FROM demand
WHERE pickup_hour >= TIMESTAMP '{FORECAST_SPLIT}'"""))
def demand_forecast_keys(spark, sf):
    return FC.demand_forecast(_all_demand(spark, sf), FORECAST_SPLIT).select("pickup_location_id", "prediction_datetime")


@register("forecast_accuracy")  # the model scored by the metrics operator: rows-only check
def forecast_accuracy(spark, sf):
    dem = _all_demand(spark, sf)
    pred = FC.demand_forecast(dem, FORECAST_SPLIT)
    return M.forecast_metrics(M.actual_vs_predicted(dem, pred), ["pickup_location_id"])


# ------------------------------------------------------------ report, catalog, counts
_REPORT_LABELS = [(label, col) for label, col in C.REPORT_LINES]


def _report_sql() -> str:
    parts = []
    for i, (label, col) in enumerate(_REPORT_LABELS, start=1):
        text = f"'{label}' || format('{{:,}}', {col})"
        if col == "records_dropped":
            text += " || ' (' || format('{:,.2f}', percent_dropped) || '%)'"
        parts.append(f"SELECT year, month, {i} AS line_no, {text} AS line FROM stats")
    return _STATS_SQL.replace("\nSELECT 2024 AS year", "\n, stats AS (SELECT 2024 AS year", 1) \
        .rstrip() + ")\n" + " UNION ALL ".join(parts)


@register("clean_stats_report", _report_sql())
def clean_stats_report(spark, sf):
    return C.stats_report(C.clean_stats(_trips(spark, sf), Y, MO))


@register("named_table_scan", _msql("SELECT pickup_hour, pickup_location_id, rides FROM demand"))
def named_table_scan(spark, sf):
    path = scratch_path(spark, "named-demand")
    SV.serve(_all_demand(spark, sf), path)
    name = "taxi_rides_" + path.rsplit("-", 1)[-1]
    SV.register_table(spark, name, path)
    return spark.table(name).select("pickup_hour", "pickup_location_id", "rides")


@register("row_counts", _msql("""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE pickup_location_id = 43) AS n_rows_43,
       count(*) FILTER (WHERE pickup_location_id = 74) AS n_rows_74,
       count(*) FILTER (WHERE pickup_location_id = 132) AS n_rows_132
FROM demand"""))
def row_counts(spark, sf):
    from ..schemas import LOCATION_NAMES
    return Q.row_counts(_all_demand(spark, sf), sorted(LOCATION_NAMES))


# ------------------------------------------------------------ co-located tables, changed months, merged metrics
@register("actual_vs_predicted_tables", _msql("""
SELECT CAST(pickup_location_id AS SMALLINT) AS pickup_location_id, pickup_hour, CAST(rides AS SMALLINT) AS rides,
       CAST(predicted_rides AS SMALLINT) AS predicted_rides FROM pairs"""))
def actual_vs_predicted_tables(spark, sf):
    """Actuals and predictions as bucketed tables of the catalog, paired without an exchange."""
    path = scratch_path(spark, "served-tables")
    tag = path.rsplit("-", 1)[-1]
    dem = S.backfill(_trips(spark, sf))
    actual = SV.save_table(dem, f"taxi_rides_{tag}", ["pickup_location_id", "pickup_hour"], schema=TAXI_RIDES, path=f"{path}/actual")
    pred = SV.save_table(fx.predictions_from_demand(dem), f"predicted_rides_{tag}", ["pickup_location_id", "prediction_datetime"],
                         schema=PREDICTED_RIDES, path=f"{path}/predicted")
    return M.actual_vs_predicted(actual, pred)


@register("changed_months", sql("""
SELECT DISTINCT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
  CASE WHEN year(tpep_pickup_datetime) = 2024 THEN 'added' WHEN month(tpep_pickup_datetime) = 12 THEN 'replaced' ELSE 'removed' END
    AS change
FROM trips""", "trips"))
def changed_months(spark, sf):
    """After a run over the 2023 months: December's files are replaced, the 2024 ones land, the others go."""
    base = scratch_path(spark, "changing-lake")
    raw, manifest = f"{base}/raw", f"{base}/manifest"
    trips = C.assign_landing_month(_trips(spark, sf))
    L.write_partitioned(trips.where("year = 2023"), raw)
    run_changed(spark, raw, f"{base}/clean", f"{base}/demand", manifest)
    L.write_partitioned(trips.where("year = 2024 or month = 12"), raw)
    gone = [(r["year"], r["month"]) for r in trips.where("year = 2023 and month <> 12").select("year", "month").distinct().collect()]
    L.drop_stale_months(spark, raw, dict.fromkeys(gone, False))
    return MF.changed_months(MF.month_states(spark, raw), MF.recorded_states(spark, manifest))


@register("forecast_metrics_merged", _msql("""
SELECT pickup_location_id, round(avg(abs(rides - p)), 4) AS mae,
       round(avg(CASE WHEN rides > 0 THEN abs(rides - p) / rides END) * 100, 4) AS mape, count(*) AS n_pairs
FROM (SELECT *, predicted_rides + CASE WHEN year(pickup_hour) = 2024 THEN 3 ELSE 0 END AS p FROM pairs)
GROUP BY pickup_location_id"""))
def forecast_metrics_merged(spark, sf):
    """Metrics by location from stored month sums after the predictions of 2024 were replaced: their old sums are
    withdrawn, the new ones added, no other pair is read again."""
    dem = _all_demand(spark, sf)
    month = [F.year("pickup_hour").alias("year"), F.month("pickup_hour").alias("month")]
    pairs = M.actual_vs_predicted(dem, fx.predictions_from_demand(dem)).select("*", *month)
    path = scratch_path(spark, "metric-sums")
    L.write_partitioned(M.metric_sums(pairs, ["year", "month", "pickup_location_id"]), path)
    stored = spark.read.parquet(path)
    replaced = pairs.where("year = 2024").withColumn("predicted_rides", F.col("predicted_rides") + 3)
    by = ["pickup_location_id"]
    total = M.merged_sums([(stored, 1), (stored.where("year = 2024"), -1), (M.metric_sums(replaced, by), 1)], by)
    return _round(M.metrics_of_sums(total, by), ["mae", "mape"])


# ------------------------------------------------------------ trend model, rolling origins (M3)
TREND = TR.TrendModel()
#: Three weekly cutoffs, a week ahead each.
FIRST_CUTOFF, EVERY, ORIGINS, AHEAD = "2024-01-08 00:00:00", 168, 3, 168


def _trend_ctes(cutoffs: str) -> dict[str, str]:
    """``ends``, ``terms`` (a row's terms as a list) and ``coefs`` (by elimination, one column a step)."""
    hour = "CAST(floor(epoch(d.pickup_hour) / 3600) AS BIGINT)"
    terms = ["1.0", "u"] + [f"greatest(0, u - {s!r})" for s in TREND.bend_points]
    for period, n in TREND.seasons:
        for k in range(1, n + 1):
            angle = f"2 * pi() * (h * {k} % {period}) / {period}"
            terms += [f"cos({angle})", f"sin({angle})"]
    p = len(terms)
    penalty = " ".join(f"WHEN {i + 1} THEN {v!r}" for i, v in enumerate(TREND.penalties))
    return {
        "ends": cutoffs,
        "scale": """SELECT CAST(floor(epoch(min(pickup_hour)) / 3600) AS BIGINT) AS h0,
  (SELECT CAST(floor(epoch(max(cutoff)) / 3600) AS BIGINT) FROM ends) AS h1 FROM demand""",
        "terms": f"""SELECT pickup_location_id, pickup_hour, rides,
  list_transform([{", ".join(terms)}], lambda x: CAST(x AS DOUBLE)) AS x
FROM (SELECT d.*, {hour} AS h, ({hour} - h0) / greatest(1, h1 - h0) AS u FROM demand d, scale)""",
        "gram": f"""SELECT pickup_location_id AS loc, cutoff, i, j,
  sum(x[i] * CASE WHEN j = {p + 1} THEN rides ELSE x[j] END) + CASE WHEN i = j THEN CASE i {penalty} END ELSE 0 END AS v
FROM terms JOIN ends ON pickup_hour < cutoff, range(1, {p + 1}) a(i), range(1, {p + 2}) b(j) GROUP BY loc, cutoff, i, j""",
        "steps": f"""SELECT loc, cutoff, i, j, v, 1 AS s FROM gram
UNION ALL
SELECT loc, cutoff, i, j, CASE WHEN i = s THEN v / pv ELSE v - f * r / pv END, s + 1 FROM (
  SELECT *, max(CASE WHEN i = s AND j = s THEN v END) OVER (PARTITION BY loc, cutoff) AS pv,
    max(CASE WHEN i = s THEN v END) OVER (PARTITION BY loc, cutoff, j) AS r,
    max(CASE WHEN j = s THEN v END) OVER (PARTITION BY loc, cutoff, i) AS f FROM steps)
WHERE s <= {p}""",
        "coefs": f"SELECT loc, cutoff, i, v AS coef FROM steps WHERE s = {p + 1} AND j = {p + 1}",
    }


def _trend_sql(body: str, cutoffs: str) -> str:
    return _msql(body, **_trend_ctes(cutoffs)).replace("WITH ", "WITH RECURSIVE ", 1)


_SPLIT = f"SELECT TIMESTAMP '{FORECAST_SPLIT}' AS cutoff"
_ORIGINS = f"""SELECT TIMESTAMP '{FIRST_CUTOFF}' + INTERVAL 1 HOUR * ({EVERY} * i) AS cutoff
FROM range({ORIGINS}) r(i)"""


def _cutoffs(spark):
    return TR.cutoffs(spark, FIRST_CUTOFF, EVERY, ORIGINS)


@register("trend_coefficients", _trend_sql(
    "SELECT loc AS pickup_location_id, cutoff, CASE i "
    + " ".join(f"WHEN {i + 1} THEN '{t}'" for i, t in enumerate(TREND.terms))
    + " END AS term, round(coef, 4) + CAST(0 AS DOUBLE) AS coef FROM coefs", _ORIGINS))
def trend_coefficients(spark, sf):
    """The fits of all cutoffs, from one pass over the series."""
    fitted = TR.coefficients(TR.fit(_all_demand(spark, sf), _cutoffs(spark), TREND), TREND)
    return fitted.withColumn("coef", F.round("coef", 4) + F.lit(0.0))


@register("trend_forecast", _trend_sql("""
SELECT pickup_location_id, pickup_hour AS prediction_datetime,
  CAST(greatest(0, round(estimate)) AS INTEGER) AS predicted_rides, round(estimate, 4) + CAST(0 AS DOUBLE) AS estimate
FROM (SELECT pickup_location_id, pickup_hour, sum(x[i] * coef) AS estimate FROM terms
  JOIN ends ON pickup_hour >= cutoff JOIN coefs ON loc = pickup_location_id GROUP BY pickup_location_id, pickup_hour)""", _SPLIT))
def trend_forecast(spark, sf):
    out = TR.trend_forecast(_all_demand(spark, sf), FORECAST_SPLIT, TREND)
    return out.withColumn("estimate", F.round("estimate", 4) + F.lit(0.0))


_HORIZONS = f"""SELECT d.*, cutoff, CAST(date_diff('hour', cutoff, pickup_hour) + 1 AS INTEGER) AS horizon
FROM demand d JOIN ends ON pickup_hour >= cutoff AND pickup_hour < cutoff + INTERVAL {AHEAD} HOUR"""
_BY_HORIZON = """SELECT CAST((horizon - 1) // 24 + 1 AS INTEGER) AS horizon_unit,
  round(avg(abs(rides - predicted_rides)), 4) AS mae,
  round(avg(CASE WHEN rides > 0 THEN abs(rides - predicted_rides) / rides END) * 100, 4) AS mape, count(*) AS n_pairs
FROM hits GROUP BY 1"""


@register("rolling_origin_keys", _msql(
    "SELECT pickup_location_id, pickup_hour, cutoff, horizon, rides FROM hor", ends=_ORIGINS, hor=_HORIZONS))
def rolling_origin_keys(spark, sf):
    return TR.horizons(_all_demand(spark, sf), _cutoffs(spark), AHEAD).select(
        "pickup_location_id", "pickup_hour", "cutoff", "horizon", "rides")


@register("rolling_seasonal_naive", _msql(_BY_HORIZON, ends=_ORIGINS, hor=_HORIZONS, hits="""
SELECT hor.*, k.rides AS predicted_rides FROM hor JOIN demand k ON k.pickup_location_id = hor.pickup_location_id
  AND k.pickup_hour = hor.pickup_hour - INTERVAL 1 HOUR * (((horizon - 1) // 168 + 1) * 168)"""))
def rolling_seasonal_naive(spark, sf):
    dem = _all_demand(spark, sf)
    pairs = TR.seasonal_naive(TR.horizons(dem, _cutoffs(spark), AHEAD), dem)
    return _round(TR.errors_by_horizon(pairs), ["mae", "mape"])


@register("rolling_trend", _msql(_BY_HORIZON, **_trend_ctes(_ORIGINS), hor=_HORIZONS, hits="""
SELECT hor.cutoff, hor.pickup_hour, hor.pickup_location_id, any_value(horizon) AS horizon, any_value(hor.rides) AS rides,
  greatest(0, round(sum(x[i] * coef))) AS predicted_rides
FROM hor JOIN terms USING (pickup_location_id, pickup_hour) JOIN coefs c
  ON c.loc = hor.pickup_location_id AND c.cutoff = hor.cutoff GROUP BY ALL""").replace("WITH ", "WITH RECURSIVE ", 1))
def rolling_trend(spark, sf):
    pairs = TR.rolling_trend(_all_demand(spark, sf), _cutoffs(spark), AHEAD, TREND)
    return _round(TR.errors_by_horizon(pairs), ["mae", "mape"])
