"""Profiling of trip tables: volumes, distributions, summaries, extremes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.columns import bin_edge, named

# The statistics of a summary, in order, and the columns of the top trips.
STATISTICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
QUARTILES = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
SUMMARY_COLUMNS = ("passenger_count", "total_amount")
TOP_COLUMNS = ("tpep_pickup_datetime", "passenger_count", "total_amount")

# The sketch that brackets quantiles is off by one rank in so many at most.
ACCURACY = 10_000


def rows_per(df: DataFrame, *keys: str) -> DataFrame:
    """Number of rows per key, sorted by key."""
    return df.groupBy(*keys).count().orderBy(*keys)


def trips_by_weekday(silver: DataFrame) -> DataFrame:
    """Trips and mean amount per day of the week, where 1 is Sunday."""
    return (
        silver.groupBy(F.dayofweek("tpep_pickup_datetime").alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("trip_count"), F.avg("total_amount").alias("avg_amount"))
        .orderBy("day_of_week")
    )


def summary_text(df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """Summary as text, one row per statistic."""
    return df.select(*columns).summary(*STATISTICS)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*(named(c).cast("double").alias(c) for c in columns))


def _brackets(column: str, probabilities: Sequence[float], accuracy: int) -> Column:
    """Values between which each quantile lies: an array of (low, high).

    They come from a mergeable sketch whose ranks are off by one part in ``accuracy`` at most.
    Two parts on either side leave room for the rounding of ranks.
    """
    margin = 2 / accuracy
    inner = [s for p in probabilities for s in (p - margin, p + margin) if 0 < s < 1]
    found = iter(range(len(inner)))
    sketch = F.percentile_approx(named(column), inner or [0.5], accuracy)

    def end(share: float) -> Column:  # beyond all ranks it is known exactly
        if share <= 0:
            return F.min(named(column))
        return F.max(named(column)) if share >= 1 else F.get(sketch, next(found))

    return F.array(
        *(
            F.struct(end(p - margin).alias("low"), end(p + margin).alias("high"))
            for p in probabilities
        )
    )


def _first_look(
    numbers: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int
) -> Column:
    """Moments of each column and brackets of its quantiles, from one pass: a struct per
    column, as a scalar subquery."""
    looks = [
        F.struct(
            F.count(named(c)).alias("rows"),
            F.avg(named(c)).alias("mean"),
            F.stddev_samp(named(c)).alias("stddev"),
            F.min(named(c)).alias("min"),
            F.max(named(c)).alias("max"),
            _brackets(c, probabilities, accuracy).alias("brackets"),
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    return numbers.agg(F.struct(*looks)).scalar()


def _wanted(
    numbers: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    looks: Column,
) -> DataFrame:
    """One row with the exact quantiles of each column: an array per column, ``q0``, ``q1`` ...

    A quantile is the smallest value that at least that share of rows reaches. Values within a
    bracket are counted one by one. All others take the value of the last bracket below them, as
    ``rest``, so one row per task and bracket stands for them. What is sorted then is the
    distinct values of the brackets, a few parts in ``accuracy`` of all.
    """
    entries = []
    for i, column in enumerate(columns):
        value, brackets = named(column), F.col(f"looks.c{i}.brackets")
        ends = [F.get(brackets, j) for j in range(len(probabilities))]
        inside = reduce(or_, ((value >= e["low"]) & (value <= e["high"]) for e in ends))
        below = [F.when(e["high"] < value, e["high"]) for e in ends]
        below = F.greatest(*below, F.lit(None).cast("double"))
        entries.append(
            F.struct(
                F.lit(i).alias("column"),
                F.when(inside, value).otherwise(below).alias("value"),
                (~inside).alias("rest"),
                value.isNotNull().alias("known"),
            )
        )
    counted = (
        numbers.withColumn("looks", looks)
        .select(F.inline(F.array(*entries)))
        .filter("known")
        .groupBy("column", "value", "rest")
        .agg(F.count(F.lit(1)).alias("n"))
        .repartition(1)
    )
    # The rest comes after the bracket that it has its value from, and first of all without one.
    in_order = Window.partitionBy("column").orderBy("value", "rest")
    running = counted.withColumn("upto", F.sum("n").over(in_order)).withColumn("looks", looks)
    found = []
    for i in range(len(columns)):
        rows = F.col(f"looks.c{i}.rows")
        quantiles = []
        for p in probabilities:
            rank = F.greatest(F.ceil(F.lit(p) * rows), F.lit(1))
            first = F.min(
                F.when((F.col("column") == i) & (F.col("upto") >= rank), F.struct("value", "rest"))
            )
            missed = F.raise_error(F.lit("a quantile lies outside of its bracket"))
            quantiles.append(F.when(first["rest"], missed.cast("double")).otherwise(first["value"]))
        found.append(F.array(*quantiles).alias(f"q{i}"))
    return running.agg(*found)


def quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Exact quantiles of one column: probability, value. A quantile is the smallest value that
    at least that share of rows reaches; there is none of no rows."""
    numbers = _numbers(df, [column])
    looks = _first_look(numbers, [column], probabilities, accuracy)
    pairs = (
        F.struct(F.lit(float(p)).alias("probability"), F.get("q0", i).alias("value"))
        for i, p in enumerate(probabilities)
    )
    found = _wanted(numbers, [column], probabilities, looks).select(F.inline(F.array(*pairs)))
    return found.filter(F.col("value").isNotNull())


def summary(
    df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, accuracy: int = ACCURACY
) -> DataFrame:
    """Summary as numbers with exact quartiles, one row per statistic, in their order.

    Two passes: moments and brackets of the quartiles, then the values within the brackets.
    """
    numbers, shares = _numbers(df, columns), list(QUARTILES)
    looks = _first_look(numbers, columns, shares, accuracy)
    found = _wanted(numbers, columns, shares, looks).withColumn("looks", looks)
    label = {name: j for j, name in enumerate(QUARTILES.values())}
    source = {"count": "rows"}

    def value(statistic: str, i: int) -> Column:
        if statistic in label:
            return F.get(f"q{i}", label[statistic])
        return F.col(f"looks.c{i}.{source.get(statistic, statistic)}").cast("double")

    rows = (
        F.struct(
            F.lit(statistic).alias("summary"),
            *(value(statistic, i).alias(c) for i, c in enumerate(columns)),
        )
        for statistic in STATISTICS
    )
    return found.select(F.inline(F.array(*rows)))


def in_band(
    df: DataFrame, lower: float = 0, upper: float = 200, column: str = "total_amount"
) -> DataFrame:
    """Rows strictly between two values, to leave outliers out of a picture."""
    return df.filter((F.col(column) > lower) & (F.col(column) < upper))


def histogram(df: DataFrame, column: str = "total_amount", bins: int = 50) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value.

    Bins are half-open except the last, and empty ones are listed. The bounds are a
    scalar subquery; counting then moves one row per bin and task. NULL and NaN belong
    to no bin.
    """
    value, lo, hi = F.col("value"), F.col("bounds.lo"), F.col("bounds.hi")
    values = df.select(F.col(column).cast("double").alias("value")).filter(
        value.isNotNull() & ~F.isnan(value)
    )
    lowest, highest = F.min(value), F.max(value)
    # A single value gets a range of width one around it.
    margin = F.when(lowest == highest, F.lit(0.5)).otherwise(F.lit(0.0))
    bounds = values.agg(
        F.struct((lowest - margin).alias("lo"), (highest + margin).alias("hi"))
    ).scalar()

    # Division can land one bin off next to an edge, so the edges decide.
    guess, last = F.col("guess"), bins - 1
    quotient = F.floor((value - lo) / ((hi - lo) / bins))
    below = value < bin_edge(guess, lo, hi, bins)
    above = (guess < last) & (value >= bin_edge(guess + 1, lo, hi, bins))
    counted = (
        values.withColumn("bounds", bounds)
        .withColumn("guess", F.least(quotient, F.lit(last)).cast("int"))
        .select(
            F.when(below, guess - 1).when(above, guess + 1).otherwise(guess).alias("bin"),
            F.lit(1).alias("trips"),
        )
    )
    # One row per bin that counts nothing, in place of an outer join.
    every_bin = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).alias("trips")
    )
    return (
        counted.unionAll(every_bin)
        .groupBy("bin")
        .agg(F.sum("trips").alias("trip_count"))
        .withColumn("bounds", bounds)
        .select(
            "bin",
            bin_edge(F.col("bin"), lo, hi, bins).alias("bin_start"),
            bin_edge(F.col("bin") + 1, lo, hi, bins).alias("bin_end"),
            "trip_count",
        )
        .orderBy("bin")
    )


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def period_bounds(df: DataFrame) -> DataFrame:
    """First and last pickup, as one row."""
    pickup = F.col("tpep_pickup_datetime")
    return df.agg(F.min(pickup).alias("first_pickup"), F.max(pickup).alias("last_pickup"))


def top_trips(df: DataFrame, rows: int = 10) -> DataFrame:
    """The most expensive trips. Ties go to the earlier, then the fuller trip."""
    return (
        df.select(*TOP_COLUMNS)
        .orderBy(
            F.desc("total_amount"), F.asc("tpep_pickup_datetime"), F.desc("passenger_count")
        )
        .limit(rows)
    )


def top_trips_stats(df: DataFrame, rows: int = 10) -> DataFrame:
    """Mean amount and mean passengers of the most expensive trips, as one row."""
    return top_trips(df, rows).agg(
        F.avg("total_amount").alias("avg_amount"),
        F.avg("passenger_count").alias("avg_passengers"),
    )
