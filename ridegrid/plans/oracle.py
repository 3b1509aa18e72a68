"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code: plain ANSI-style SQL over the
pre-registered ``events`` view.  Common CTEs are declared once with their
dependencies; ``sql(body, *needs)`` emits only the CTEs a query uses.
"""
from __future__ import annotations

_REQUIRED = ("tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL "
             "AND total_amount IS NOT NULL AND PULocationID IS NOT NULL "
             "AND DOLocationID IS NOT NULL AND trip_distance IS NOT NULL "
             "AND passenger_count IS NOT NULL")
_IN_JAN = ("tpep_pickup_datetime >= TIMESTAMP '2024-01-01 00:00:00' "
           "AND tpep_pickup_datetime < TIMESTAMP '2024-02-01 00:00:00'")
_DURATION = ("CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT) "
             "- CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT)")
_RANGES = ("duration > 0 AND duration <= max_duration "
           "AND total_amount >= 2.5 AND total_amount <= max_total_amount "
           "AND trip_distance > 0 AND trip_distance <= max_distance "
           "AND PULocationID NOT IN (1, 264, 265) "
           "AND passenger_count >= 1 AND passenger_count <= 5")
_FINAL_COLS = ("CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime, "
               "CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime, "
               "CAST(PULocationID AS INTEGER) AS pickup_location_id, "
               "CAST(DOLocationID AS INTEGER) AS dropoff_location_id, "
               "CAST(trip_distance AS DOUBLE) AS trip_distance, "
               "CAST(fare_amount AS DOUBLE) AS fare_amount, "
               "CAST(tip_amount AS DOUBLE) AS tip_amount, "
               "CAST(payment_type AS INTEGER) AS payment_type, "
               "CAST(passenger_count AS INTEGER) AS passenger_count")

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": ((), """
SELECT
 CASE WHEN event_id % 101 = 0 THEN ts - INTERVAL '40' DAY ELSE ts END AS tpep_pickup_datetime,
 CASE WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 101 = 0 THEN ts - INTERVAL '40' DAY + INTERVAL '1' SECOND * ((event_id * 37) % 3600 - 60)
      ELSE ts + INTERVAL '1' SECOND * ((event_id * 37) % 3600 - 60) END AS tpep_dropoff_datetime,
 CAST(CASE WHEN event_id % 89 = 0 THEN NULL
      WHEN user_id % 50 = 0 THEN 264 WHEN user_id % 50 = 1 THEN 265
      WHEN user_id % 50 = 2 THEN 1 WHEN user_id % 50 = 3 THEN 132
      ELSE user_id % 50 + 39 END AS INT) AS PULocationID,
 CAST((user_id * 7) % 265 + 1 AS INT) AS DOLocationID,
 CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(event_id % 61 AS DOUBLE) / 4 END AS trip_distance,
 value AS total_amount, value * 0.75 AS fare_amount, value * 0.125 AS tip_amount,
 CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
      WHEN 'signup' THEN 4 ELSE 5 END AS INT) AS payment_type,
 CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END AS passenger_count
FROM events"""),
    "not_null": (("trips",), f"SELECT * FROM trips WHERE {_REQUIRED}"),
    "prepared": (("not_null",), f"SELECT *, {_DURATION} AS duration FROM not_null WHERE {_IN_JAN}"),
    "qbounds": (("prepared",), """
SELECT max(CAST(duration AS DOUBLE)) AS max_duration,
       max(total_amount) FILTER (WHERE NOT isnan(total_amount)) AS max_total_amount,
       max(trip_distance) FILTER (WHERE NOT isnan(trip_distance)) AS max_distance
FROM prepared"""),
    "filtered": (("prepared", "qbounds"), f"SELECT prepared.* FROM prepared, qbounds WHERE {_RANGES}"),
    "final": (("filtered",), f"SELECT {_FINAL_COLS} FROM filtered"),
    "counts": (("final",), """
SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, pickup_location_id,
       count(*) AS rides
FROM final GROUP BY 1, 2"""),
    "hbounds": (("counts",), "SELECT min(pickup_hour) AS lo, max(pickup_hour) AS hi FROM counts"),
    "grid": (("counts", "hbounds"), """
SELECT h.pickup_hour, l.pickup_location_id
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS pickup_hour FROM hbounds) h
CROSS JOIN (SELECT DISTINCT pickup_location_id FROM counts) l"""),
    "demand": (("grid", "counts"), """
SELECT g.pickup_hour, g.pickup_location_id, CAST(coalesce(c.rides, 0) AS INTEGER) AS rides
FROM grid g LEFT JOIN counts c
  ON g.pickup_hour = c.pickup_hour AND g.pickup_location_id = c.pickup_location_id"""),
    "predictions": (("demand",), """
SELECT pickup_location_id, pickup_hour AS prediction_datetime,
       CAST(greatest(0, rides + (pickup_location_id * 31 + hour(pickup_hour) * 17
                               + day(pickup_hour) * 7) % 5 - 2) AS INTEGER) AS predicted_rides
FROM demand WHERE hour(pickup_hour) NOT IN (0, 23)"""),
    "pairs": (("demand", "predictions"), """
SELECT d.pickup_location_id, d.pickup_hour, d.rides, p.predicted_rides
FROM demand d JOIN predictions p
  ON d.pickup_location_id = p.pickup_location_id AND d.pickup_hour = p.prediction_datetime"""),
}


def _order(needs: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)
    for n in needs:
        visit(n)
    return seen


def sql(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the needed CTEs (in dependency order), then ``body``."""
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in _order(needs)]
    for name, text in (extra or {}).items():
        parts.append(f"{name} AS ({text.strip()})")
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
