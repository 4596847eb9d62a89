"""The answers as SQL text, run on frames: ``spark.sql(TEXT, silver=frame)``."""

# Defaults of the month parameters below.
DEFAULT_MONTH = {"year": 2023, "month": 5}

AMOUNT_BY_MONTH = """
SELECT trip_year, trip_month, round(avg(total_amount), 2) AS avg_total_amount
FROM {silver}
GROUP BY ALL
ORDER BY trip_year, trip_month
"""

PASSENGERS_BY_HOUR = """
SELECT hour(tpep_pickup_datetime) AS pickup_hour,
       round(avg(passenger_count), 2) AS avg_passenger_count
FROM {silver}
WHERE trip_year = :year AND trip_month = :month
GROUP BY ALL
ORDER BY pickup_hour
"""

AMOUNT_AND_TRIPS_BY_MONTH = """
SELECT make_timestamp_ntz(trip_year, trip_month, 1, 0, 0, 0) AS month_start,
       round(avg(total_amount), 2) AS avg_total_amount,
       count(*) AS num_trips
FROM {silver}
WHERE total_amount > 0
GROUP BY trip_year, trip_month
ORDER BY month_start
"""

PASSENGERS_AND_TRIPS_BY_HOUR = """
SELECT hour(tpep_pickup_datetime) AS trip_hour,
       round(avg(passenger_count), 2) AS avg_passenger_count,
       count(*) AS num_trips
FROM {silver}
WHERE trip_year = :year AND trip_month = :month AND passenger_count > 0
GROUP BY ALL
ORDER BY trip_hour
"""

SERVE_MONTH = """
SELECT trip_year, trip_month, avg_total_amount
FROM {mart}
ORDER BY trip_year, trip_month
"""

SERVE_HOUR = """
SELECT pickup_hour, avg_passenger_count
FROM {mart}
ORDER BY pickup_hour
"""

LAYER_COUNTS = """
SELECT (SELECT count(*) FROM {bronze}) AS bronze_rows,
       (SELECT count(*) FROM {silver}) AS silver_rows
"""
