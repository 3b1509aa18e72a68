"""Declared schemas of the layers, and the dashboard location lookup."""
from __future__ import annotations

from pyspark.sql import types as T

# Raw trip columns the cleaning job reads (other columns are ignored).
RAW_PICKUP = "tpep_pickup_datetime"
RAW_DROPOFF = "tpep_dropoff_datetime"
RAW_PU = "PULocationID"
RAW_DO = "DOLocationID"

# Columns whose null makes a trip unusable (fare, tip, payment type may be null).
REQUIRED_COLUMNS = [
    RAW_PICKUP, RAW_DROPOFF, "total_amount", RAW_PU, RAW_DO,
    "trip_distance", "passenger_count",
]

# Types that the cleaning job compares by, for columns that arrive as text.
RAW_TYPES = {RAW_PICKUP: "timestamp_ntz", RAW_DROPOFF: "timestamp_ntz", RAW_PU: "bigint", RAW_DO: "bigint",
             "trip_distance": "double", "total_amount": "double", "fare_amount": "double", "tip_amount": "double",
             "payment_type": "bigint", "passenger_count": "double"}

# Pickup zones outside the city proper, and filter edges.
EXCLUDED_LOCATIONS = [1, 264, 265]
MIN_TOTAL_AMOUNT = 2.5
MIN_PASSENGERS = 1
MAX_PASSENGERS = 5
UPPER_QUANTILE = 0.999
QUANTILE_REL_ERR = 0.01

# Cleaned trips: 9 typed columns.
CLEAN_TRIPS = T.StructType([
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pickup_location_id", T.IntegerType()),
    T.StructField("dropoff_location_id", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
])

# Served hourly demand table (narrow types on disk).
TAXI_RIDES = T.StructType([
    T.StructField("pickup_hour", T.TimestampNTZType()),
    T.StructField("pickup_location_id", T.ShortType()),
    T.StructField("rides", T.ShortType()),
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ShortType()),
])

# Served prediction table.
PREDICTED_RIDES = T.StructType([
    T.StructField("pickup_location_id", T.ShortType()),
    T.StructField("prediction_datetime", T.TimestampNTZType()),
    T.StructField("predicted_rides", T.ShortType()),
])

# Columns of one prediction CSV file (path keys are added by partition discovery).
PREDICTION_CSV = T.StructType([
    T.StructField("prediction_datetime", T.TimestampNTZType()),
    T.StructField("predicted_rides", T.IntegerType()),
])

# Dashboard locations and their names.
LOCATION_NAMES = {
    43: "Lower East Side",
    74: "East Harlem",
    132: "JFK Airport",
}

SERVED_TIMEZONE = "America/New_York"
HOUR_FORMAT = "yyyy-MM-dd HH:mm:ss"
