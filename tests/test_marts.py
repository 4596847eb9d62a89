"""Answer tables."""

from datetime import datetime

from tripmart.operators import marts
from tripmart.plans import sql

SCHEMA = (
    "trip_year int, trip_month int, total_amount double, passenger_count int, "
    "tpep_pickup_datetime timestamp"
)


def silver(spark, *rows):
    """Rows of pickup, amount and passengers."""
    return spark.createDataFrame(
        [(t.year, t.month, amount, passengers, t) for t, amount, passengers in rows], SCHEMA
    )


MAY_10H = datetime(2023, 5, 17, 10, 2)
MAY_10H_LATER = datetime(2023, 5, 29, 10, 59)
MAY_22H = datetime(2023, 5, 9, 22)
APRIL_10H = datetime(2023, 4, 1, 10)


def values(df):
    return [tuple(row) for row in df.collect()]


def test_mean_amount_of_a_month(spark):
    df = silver(spark, (MAY_10H, 7.5, 1), (MAY_10H_LATER, 12.0, 1))
    result = marts.amount_by_month(df)
    assert values(result) == [(2023, 5, 9.75)]
    assert result.schema.simpleString() == (
        "struct<trip_year:int,trip_month:int,avg_total_amount:double>"
    )


def test_mean_passengers_of_an_hour(spark):
    df = silver(spark, (MAY_10H, 1.0, 1), (MAY_10H_LATER, 1.0, 6))
    result = marts.passengers_by_hour(df)
    assert values(result) == [(10, 3.5)]
    assert result.schema.simpleString() == "struct<pickup_hour:int,avg_passenger_count:double>"


def test_hours_of_other_months_stay_out_and_empty_hours_give_no_row(spark):
    df = silver(spark, (MAY_22H, 1.0, 1), (MAY_10H, 1.0, 2), (APRIL_10H, 1.0, 9))
    assert values(marts.passengers_by_hour(df)) == [(10, 2.0), (22, 1.0)]


def test_rounding_comes_after_averaging(spark):
    df = silver(spark, (MAY_10H, 1.0, 1), (MAY_10H, 0.0, 1), (MAY_10H, 0.0, 2))
    assert values(marts.amount_by_month(df)) == [(2023, 5, 0.33)]
    assert values(marts.passengers_by_hour(df)) == [(10, 1.33)]


def test_months_come_sorted(spark):
    df = silver(spark, (MAY_10H, 1.0, 1), (APRIL_10H, 2.0, 1))
    assert values(marts.amount_by_month(df)) == [(2023, 4, 2.0), (2023, 5, 1.0)]


def test_counted_month_leaves_out_free_rides(spark):
    df = silver(spark, (MAY_10H, 0.0, 1), (MAY_10H, 3.0, 1))
    assert values(marts.amount_and_trips_by_month(df)) == [(datetime(2023, 5, 1), 3.0, 1)]
    assert values(marts.amount_by_month(df)) == [(2023, 5, 1.5)]


def test_counted_hour(spark):
    df = silver(spark, (MAY_10H, 1.0, 2), (MAY_10H_LATER, 1.0, 3), (APRIL_10H, 1.0, 9))
    assert values(marts.passengers_and_trips_by_hour(df)) == [(10, 2.5, 2)]


def test_sql_gives_the_same(spark):
    df = silver(spark, (MAY_22H, 1.0, 1), (MAY_10H, 1.5, 2), (APRIL_10H, 1.0, 9))
    for text, mart in (
        (sql.AMOUNT_BY_MONTH, marts.amount_by_month),
        (sql.AMOUNT_AND_TRIPS_BY_MONTH, marts.amount_and_trips_by_month),
    ):
        assert values(spark.sql(text, silver=df)) == values(mart(df))
    for text, mart in (
        (sql.PASSENGERS_BY_HOUR, marts.passengers_by_hour),
        (sql.PASSENGERS_AND_TRIPS_BY_HOUR, marts.passengers_and_trips_by_hour),
    ):
        assert values(spark.sql(text, sql.DEFAULT_MONTH, silver=df)) == values(mart(df))


def test_other_year_and_month(spark):
    df = silver(spark, (datetime(2024, 1, 1, 7), 1.0, 2), (MAY_10H, 1.0, 3))
    assert values(marts.passengers_by_hour(df, 2024, 1)) == [(7, 2.0)]
