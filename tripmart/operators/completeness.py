"""Which months have not arrived yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.config import BRONZE_PARTITIONS, DEFAULT_PERIOD, Period


def missing_months(bronze: DataFrame, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Months of the period without a single ingested row.

    The period filter prunes partitions, and no data column is read. Both sides of the
    join have at most twelve rows, one per month of the period.
    """
    spark = bronze.sparkSession
    expected = spark.range(period.first_month, period.last_month + 1).select(
        F.lit(period.year).alias("_ref_year"), F.col("id").cast("int").alias("_ref_month")
    )
    arrived = (
        bronze.filter(
            (F.col("_ref_year") == period.year)
            & F.col("_ref_month").between(period.first_month, period.last_month)
        )
        .select(*BRONZE_PARTITIONS)
        .distinct()
    )
    return expected.join(F.broadcast(arrived), list(BRONZE_PARTITIONS), "left_anti").orderBy(
        *BRONZE_PARTITIONS
    )
