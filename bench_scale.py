"""Pipeline timings at the size of a real season: five monthly files, many million trips.

Multiplies the lineitem rows by shifted copies, writes them as landing files with
drifting types, then times each layer. Usage: bench_scale.py [copies], 25 by default,
which makes 15 million rows out of sf0.1.
"""

from __future__ import annotations

import json
import os
import sys
import time
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.config import Lake
from tripmart.plans import pipeline
from tripmart.sources.scratch import scratch_folder


def season(spark: SparkSession, sf_dir: str, copies: int):
    """Trips of January to May 2023, one in eleven repeated."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    copied = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    again = F.when(F.col("l_orderkey") % 11 == 0, 2).otherwise(1)
    seconds = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "copy"), F.lit(151 * 86400))
    pickup = (F.lit(1672531200) + seconds).cast("timestamp").cast("timestamp_ntz")
    return (
        copied.withColumn("again", F.explode(F.sequence(F.lit(1), again)))
        .withColumn("tpep_pickup_datetime", pickup)
        .select(
            F.col("l_suppkey").alias("VendorID"),
            (F.col("l_quantity").cast("int") % 7).cast("double").alias("passenger_count"),
            (F.col("l_extendedprice") - 5000).alias("total_amount"),
            "tpep_pickup_datetime",
            F.expr("tpep_pickup_datetime + make_dt_interval(0, 0, l_quantity)").alias(
                "tpep_dropoff_datetime"
            ),
            "l_orderkey",
            "l_partkey",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
            F.col("l_linenumber").alias("airport_fee"),
        )
    )


def write_season(spark: SparkSession, sf_dir: str, copies: int) -> str:
    folder = scratch_folder(spark, "season")
    trips = season(spark, sf_dir, copies)
    for month in range(1, 6):
        fee = F.col("airport_fee").cast("bigint" if month % 2 else "double")
        (
            trips.filter(F.month("tpep_pickup_datetime") == month)
            .withColumn("airport_fee", fee)
            .write.parquet(f"{folder}/trips_2023-{month:02d}.parquet")
        )
    return folder


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 25
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart-bench-scale")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tag = uuid4().hex
    timings = {}

    def timed(name, step):
        start = time.perf_counter()
        result = step()
        timings[name] = round(time.perf_counter() - start, 2)
        return result

    landing = timed("write_landing", lambda: write_season(spark, sf_dir, copies))
    lake = Lake(
        landing,
        bronze_schema=f"bronze_{tag}",
        silver_schema=f"silver_{tag}",
        gold_schema=f"gold_{tag}",
        location=scratch_folder(spark, "season-tables"),
    )
    bronze = timed("bronze", lambda: pipeline.build_bronze(spark, lake))
    silver = timed("silver", lambda: pipeline.build_silver(spark, lake))
    timed("gold", lambda: pipeline.build_gold(spark, lake, pipeline.default_marts()))
    tables = {
        "bronze": lake.bronze_table,
        "silver": lake.silver_table,
        "month_mart": lake.gold_table(pipeline.MONTH_MART),
    }
    files = {name: len(spark.table(table).inputFiles()) for name, table in tables.items()}
    print(
        json.dumps(
            {
                "bronze_rows": bronze,
                "silver_rows": silver,
                "seconds": timings,
                "bronze_rows_per_sec": round(bronze / timings["bronze"]),
                "silver_input_rows_per_sec": round(bronze / timings["silver"]),
                "files": files,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
