"""Test views derived from the shared ``events`` table (see FIXTURES.md).

``trips`` re-expresses the raw monthly trip file as a deterministic function of
``events`` so every query's work grows with the input tables.  ``demand`` and
``predictions`` are derived from it with the library's own operators.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURE_YEAR = 2024
FIXTURE_MONTH = 1
# Fixed anchor of the week window: 2025-01-12 10:20:00 New York time, as UTC.
WEEK_ANCHOR_UTC = "2025-01-12 15:20:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trip records (yellow-taxi column names) derived row by row from events."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    shifted = eid % 101 == 0
    pickup = F.when(shifted, F.timestamp_add("DAY", F.lit(-40), ts)).otherwise(ts)
    offset = (eid * 37) % 3600 - 60
    dropoff = F.when(eid % 97 == 0, F.lit(None)).otherwise(F.timestamp_add("SECOND", offset, pickup))
    bucket = uid % 50
    pu = (F.when(eid % 89 == 0, F.lit(None))
          .when(bucket == 0, F.lit(264)).when(bucket == 1, F.lit(265))
          .when(bucket == 2, F.lit(1)).when(bucket == 3, F.lit(132))
          .otherwise(bucket + 39))
    payment = (F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2)
               .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4)
               .otherwise(5))
    return events.select(
        pickup.alias("tpep_pickup_datetime"),
        dropoff.cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        pu.cast("int").alias("PULocationID"),
        ((uid * 7) % 265 + 1).cast("int").alias("DOLocationID"),
        F.when(eid % 83 == 0, F.lit(None)).otherwise((eid % 61).cast("double") / 4)
        .alias("trip_distance"),
        F.col("value").alias("total_amount"),
        (F.col("value") * 0.75).alias("fare_amount"),
        (F.col("value") * 0.125).alias("tip_amount"),
        payment.cast("int").alias("payment_type"),
        F.when(eid % 53 == 0, F.lit(None)).otherwise((eid % 8).cast("double"))
        .alias("passenger_count"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(table(spark, sf_dir, "events"))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned 2024-01 trips as a dense, zero-filled hour x location series."""
    from .operators.clean import clean_trips, finalize_trips
    from .operators.series import hourly_demand
    clean = finalize_trips(clean_trips(trips(spark, sf_dir), FIXTURE_YEAR, FIXTURE_MONTH))
    return hourly_demand(clean).select("pickup_hour", "pickup_location_id", "rides")


def predictions_from_demand(dem: DataFrame) -> DataFrame:
    """Deterministic stand-in forecasts; hours 0 and 23 are missing on purpose."""
    h = F.hour("pickup_hour")
    noise = (F.col("pickup_location_id") * 31 + h * 17 + F.dayofmonth("pickup_hour") * 7) % 5 - 2
    return dem.where(~h.isin(0, 23)).select(
        "pickup_location_id",
        F.col("pickup_hour").alias("prediction_datetime"),
        F.greatest(F.lit(0), F.col("rides") + noise).cast("int").alias("predicted_rides"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from_demand(demand(spark, sf_dir))


#: Physical types of three kinds of monthly files; a column not named keeps its type.
MONTH_TYPES = [
    {"passenger_count": "bigint", "PULocationID": "bigint", "trip_distance": "decimal(10,2)", "payment_type": "smallint"},
    {"passenger_count": "int", "DOLocationID": "double", "tpep_dropoff_datetime": "timestamp", "payment_type": "string"},
    {"PULocationID": "double", "trip_distance": "float", "total_amount": "double"},
]


def write_mixed_lake(spark: SparkSession, sf_dir: str, base: str) -> None:
    """``trips`` as a raw lake whose months were written with different physical types."""
    from .operators.clean import assign_landing_month
    from .sources.lake import write_partitioned
    keyed = assign_landing_month(trips(spark, sf_dir))
    for i, types in enumerate(MONTH_TYPES):
        part = keyed.where((F.col("year") * 12 + F.col("month")) % len(MONTH_TYPES) == i)
        part = part.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
        if i == 1:
            part = part.withColumn("airport_fee", F.lit(1.25)).withColumnRenamed("fare_amount", "Fare_Amount")
        write_partitioned(part, base, mode="append")
