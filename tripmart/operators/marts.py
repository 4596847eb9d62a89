"""Answer tables built from trusted trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import DEFAULT_HOUR_MONTH, DEFAULT_PERIOD


def rounded_mean(column: str, digits: int = 2) -> Column:
    """Mean per trip, rounded after averaging and named ``avg_<column>``."""
    return F.round(F.avg(column), digits).alias(f"avg_{column}")


def amount_by_month(silver: DataFrame) -> DataFrame:
    """Mean amount per month."""
    months = ["trip_year", "trip_month"]
    return silver.groupBy(*months).agg(rounded_mean("total_amount")).orderBy(*months)


def _one_month(silver: DataFrame, year: int, month: int) -> DataFrame:
    """Trips of one month; reads only that partition of a stored table."""
    return silver.filter((F.col("trip_year") == year) & (F.col("trip_month") == month))


def passengers_by_hour(
    silver: DataFrame, year: int = DEFAULT_PERIOD.year, month: int = DEFAULT_HOUR_MONTH
) -> DataFrame:
    """Mean passengers per pickup hour of one month; hours without trips are absent."""
    hour = F.hour("tpep_pickup_datetime").alias("pickup_hour")
    return (
        _one_month(silver, year, month)
        .groupBy(hour)
        .agg(rounded_mean("passenger_count"))
        .orderBy("pickup_hour")
    )


def amount_and_trips_by_month(silver: DataFrame) -> DataFrame:
    """Mean amount and number of paid trips per month, keyed by its first day.

    Groups by the stored month, so that the pickup column is not read at all.
    """
    first_day = F.make_timestamp_ntz(
        "trip_year", "trip_month", F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )
    return (
        silver.filter(F.col("total_amount") > 0)
        .groupBy("trip_year", "trip_month")
        .agg(rounded_mean("total_amount"), F.count(F.lit(1)).alias("num_trips"))
        .select(first_day.alias("month_start"), "avg_total_amount", "num_trips")
        .orderBy("month_start")
    )


def passengers_and_trips_by_hour(
    silver: DataFrame, year: int = DEFAULT_PERIOD.year, month: int = DEFAULT_HOUR_MONTH
) -> DataFrame:
    """Mean passengers and number of trips per pickup hour of one month."""
    hour = F.hour("tpep_pickup_datetime").alias("trip_hour")
    return (
        _one_month(silver, year, month)
        .filter(F.col("passenger_count") > 0)
        .groupBy(hour)
        .agg(rounded_mean("passenger_count"), F.count(F.lit(1)).alias("num_trips"))
        .orderBy("trip_hour")
    )
