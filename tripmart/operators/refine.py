"""From ingested rows to trusted trips: select, type, validate, deduplicate."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripmart.config import DEFAULT_PERIOD, SNAKE_CASE, TRIP_COLUMNS, Period
from tripmart.functions.columns import within


def select_required(df: DataFrame) -> DataFrame:
    """The five trip columns, in order."""
    return df.select(*TRIP_COLUMNS)


def rename_snake_case(df: DataFrame) -> DataFrame:
    """Snake-case names. Trusted tables keep the published names by default."""
    return df.withColumnsRenamed(SNAKE_CASE)


def cast_trip_types(df: DataFrame) -> DataFrame:
    """Cast the trip columns; a value that does not fit becomes NULL.

    Fractions are cut off, so half a passenger is none. That goes for numbers in text as
    well, which a direct cast to int would refuse.
    """
    text = {c.lower() for c, t in df.dtypes if t == "string"}

    def cast(column: str, to: str) -> Column:
        value = F.col(column)
        if to == "int" and column.lower() in text:
            value = value.try_cast("double")
        return value.try_cast(to)

    return df.withColumns({c: cast(c, t) for c, t in TRIP_COLUMNS.items()})


def add_event_month(df: DataFrame) -> DataFrame:
    """Year and month of the pickup, which rule the layout from here on."""
    pickup = F.col("tpep_pickup_datetime")
    return df.withColumns({"trip_year": F.year(pickup), "trip_month": F.month(pickup)})


def quality_rules(period: Period = DEFAULT_PERIOD, reject_nan: bool = False) -> list[Column]:
    """What a trusted trip satisfies.

    No comparison holds for NULL, so each rule also demands that its columns are known;
    the vendor is not tested. Zero is a valid amount, but not a valid number of
    passengers. NaN sorts above every number, so it passes unless ``reject_nan`` is set.
    """
    pickup, amount = F.col("tpep_pickup_datetime"), F.col("total_amount")
    rules = [
        within(pickup, period),
        F.col("tpep_dropoff_datetime") >= pickup,
        F.col("passenger_count") > 0,
        amount >= 0,
    ]
    return rules + [~F.isnan(amount)] if reject_nan else rules


def filter_valid(
    df: DataFrame, period: Period = DEFAULT_PERIOD, reject_nan: bool = False
) -> DataFrame:
    """Typed rows that satisfy every quality rule."""
    return df.filter(reduce(and_, quality_rules(period, reject_nan)))


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per distinct trip; NULLs count as equal."""
    return df.dropDuplicates(list(TRIP_COLUMNS))


def _skip_unoccupied(df: DataFrame) -> DataFrame:
    """Drop rows without passengers before the cast, where the scan can do it."""
    column = df.select("passenger_count")
    if isinstance(column.schema.fields[0].dataType, NumericType):
        return df.filter(F.col("passenger_count") >= 1)
    return df


def refine(
    bronze: DataFrame, period: Period = DEFAULT_PERIOD, reject_nan: bool = False
) -> DataFrame:
    """Trusted trips from ingested rows.

    The event month follows from the pickup, so it is added last and stays out of the
    shuffle that removes duplicates. Copies meet in the map tasks first: however often
    a trip is repeated, each task sends it once.
    """
    columns = _skip_unoccupied(select_required(bronze))
    valid = filter_valid(cast_trip_types(columns), period, reject_nan)
    return add_event_month(deduplicate(valid))
