"""Column expressions shared by sources and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.config import Period

def named(column: str) -> Column:
    """A column by its exact name, also when the name holds dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def within(ts: Column, period: Period) -> Column:
    """True inside the period, as a half-open range that parquet scans can use."""
    return (ts >= F.lit(period.start).cast("timestamp")) & (
        ts < F.lit(period.end).cast("timestamp")
    )


def bin_edge(index: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Left edge of an equal-width bin; index ``bins`` gives ``hi`` itself."""
    return F.when(index == bins, hi).otherwise(index * ((hi - lo) / bins) + lo)
