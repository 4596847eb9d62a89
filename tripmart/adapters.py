"""Trip-shaped input from the test tables, which hold no trips of their own.

The texts run in Spark and in other SQL engines alike. Besides the five trip columns
they give a fee and a flag, from which landing files with drifting schemas are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import TRIP_COLUMNS, Period
from tripmart.sources.scratch import scratch_folder

_EVENTS = """
select user_id as VendorID,
       cast(user_id % 5 as double) as passenger_count,
       value - 5 as total_amount,
       ts as tpep_pickup_datetime,
       case when event_id % 17 = 0 then ts - interval '1' hour
            else ts + interval '20' minute end as tpep_dropoff_datetime,
       cast(event_id % 7 as int) as fee,
       event_type as flag
from {source}
"""

_LINEITEM = """
select l_suppkey as VendorID,
       cast(cast(l_quantity as int) % 7 as double) as passenger_count,
       l_extendedprice - 5000 as total_amount,
       l_shipdate as tpep_pickup_datetime,
       case when l_orderkey % 17 = 0 then l_shipdate - interval '1' day
            else l_shipdate + interval '1' day end as tpep_dropoff_datetime,
       l_linenumber as fee,
       l_returnflag as flag
from {source}
"""

# A slice of the input that was ingested twice.
_AGAIN = "VendorID % 10 = 0"


@dataclass(frozen=True)
class Adapter:
    """How to read one test table as trips, and which period to ask for."""

    table: str
    sql: str
    period: Period
    hour_month: int

    def raw_sql(self) -> str:
        return self.sql.format(source=self.table)

    def ingested_sql(self) -> str:
        return (
            f"with raw as ({self.raw_sql()}) "
            f"select * from raw union all select * from raw where {_AGAIN}"
        )


EVENTS = Adapter("events", _EVENTS, Period(2024, 1, 1), 1)
LINEITEM = Adapter("lineitem", _LINEITEM, Period(1995, 1, 5), 5)


def raw_rows(spark: SparkSession, sf_dir: str, adapter: Adapter) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{adapter.table}.parquet")
    return spark.sql(adapter.sql, source=source)


def again(raw: DataFrame) -> DataFrame:
    return raw.filter(_AGAIN)


def ingested_trips(spark: SparkSession, sf_dir: str, adapter: Adapter) -> DataFrame:
    """The five trip columns, with the slice that was ingested twice."""
    raw = raw_rows(spark, sf_dir, adapter).select(*TRIP_COLUMNS)
    return raw.unionAll(again(raw))


def _fee(sql_type: str, name: str = "airport_fee") -> Column:
    return F.col("fee").cast(sql_type).alias(name)


# What the files of a year look like, by year modulo five.
_VARIANTS = {
    0: lambda: [F.col("passenger_count"), _fee("bigint")],
    1: lambda: [
        F.col("passenger_count").cast("bigint").alias("passenger_count"),
        _fee("double"),
        F.concat(F.lit("c"), F.col("fee").cast("string")).alias("code"),
    ],
    2: lambda: [F.col("passenger_count"), _fee("bigint", "code")],
    3: lambda: [F.col("passenger_count"), _fee("decimal(10,2)", "Airport_fee")],
    4: lambda: [F.col("passenger_count"), _fee("double"), F.col("flag").alias("note")],
}


# Rows without a pickup land in a month of their own, which no period asks for.
UNDATED = "1900-01-01"


def write_landing(
    spark: SparkSession,
    sf_dir: str,
    adapter: Adapter,
    where: str = "true",
    folder: str | None = None,
) -> str:
    """Write the raw rows as landing folders, one per month, and the repeated slice as
    further folders with another prefix. Returns the landing path.

    Only rows for which ``where`` holds land, in a fresh folder or beside what is in ``folder``.
    A shuffle brings each entry together, split only where it is large: the files grow with the
    bytes, not with tasks times months.
    """
    folder = folder or scratch_folder(spark, f"landing-{adapter.table}")
    once, twice = F.array(F.lit("trips")), F.array(F.lit("trips"), F.lit("rerun"))
    rows = raw_rows(spark, sf_dir, adapter).filter(where).select(
        "*", F.explode(F.when(F.expr(_AGAIN), twice).otherwise(once)).alias("prefix")
    )
    pickup = F.coalesce("tpep_pickup_datetime", F.lit(UNDATED).cast("timestamp_ntz"))
    for remainder, variant in _VARIANTS.items():
        (
            rows.filter(F.year(pickup) % 5 == remainder)
            .select(
                "VendorID",
                *variant(),
                "total_amount",
                "tpep_pickup_datetime",
                "tpep_dropoff_datetime",
                # A partition folder named file=<prefix>_YYYY-MM.parquet is a landing entry.
                F.concat_ws("_", "prefix", F.date_format(pickup, "yyyy-MM'.parquet'")).alias(
                    "file"
                ),
            )
            .hint("rebalance", "file")
            .write.mode("append")
            .partitionBy("file")
            .parquet(folder)
        )
    return folder
