"""Table writes, refreshes and the whole pipeline."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import BASE, raw_trips
from tripmart import adapters
from tripmart.config import Lake, Period, applied, session_settings
from tripmart.operators.refine import refine
from tripmart.plans import pipeline, sql
from tripmart.sources import tables
from tripmart.sources.landing import read_landing
from tripmart.sources.scratch import WAREHOUSE_DIR, scratch_folder


@pytest.fixture
def schema(spark, tmp_path, request):
    name = f"t_{abs(hash((request.node.name, str(tmp_path))))}"
    tables.ensure_schema(spark, name, f"{tmp_path}/{name}")
    return name


@pytest.fixture
def lake(spark, tmp_path, schema):
    """Landing files of April and May: in each a trip twice, and one without passengers."""
    for month, amount in ((4, 10.0), (5, 20.0)):
        trip = {
            "tpep_pickup_datetime": datetime(2023, month, 3, 7),
            "tpep_dropoff_datetime": datetime(2023, month, 3, 8),
            "total_amount": amount,
        }
        rows = raw_trips(spark, trip, trip, trip | {"passenger_count": 0.0})
        kind = "bigint" if month == 4 else "double"
        rows.withColumn("VendorID", F.col("VendorID").cast(kind)).write.parquet(
            f"{tmp_path}/landing/trips_2023-{month:02d}.parquet"
        )
    return Lake(
        f"{tmp_path}/landing",
        bronze_schema=f"{schema}_bronze",
        silver_schema=f"{schema}_silver",
        gold_schema=f"{schema}_gold",
        location=f"{tmp_path}/lake",
    )


def months(spark, *numbers, amount=1.0):
    return refine(
        raw_trips(
            spark,
            *(
                {
                    "tpep_pickup_datetime": datetime(2023, m, 3),
                    "tpep_dropoff_datetime": datetime(2023, m, 4),
                    "total_amount": amount,
                }
                for m in numbers
            ),
        )
    )


def amounts(spark, name):
    return {r.trip_month: r.total_amount for r in spark.table(name).collect()}


@pytest.mark.parametrize("table_format", ["parquet", "orc"])
def test_write_returns_the_rows_written(spark, schema, table_format):
    name = f"{schema}.silver"
    assert tables.write_silver(months(spark, 1, 2, 3), name, table_format) == 3
    assert tables.write_silver(months(spark, 4), name, table_format) == 1
    assert amounts(spark, name) == {4: 1.0}
    assert spark.table(name).inputFiles()[0].endswith(table_format)


def test_overwrite_replaces_the_schema(spark, schema):
    name = f"{schema}.mart"
    tables.write_gold(spark.range(2), name)
    tables.write_gold(spark.createDataFrame([("a", 1.0)], "k string, v double"), name)
    assert spark.table(name).columns == ["k", "v"]


def test_partition_columns(spark, schema):
    name = f"{schema}.silver"
    tables.write_silver(months(spark, 1, 2), name)
    partitions = [r.partition for r in spark.sql(f"show partitions {name}").collect()]
    assert sorted(partitions) == ["trip_year=2023/trip_month=1", "trip_year=2023/trip_month=2"]


def test_one_file_per_small_month(spark, schema):
    name = f"{schema}.silver"
    busy = months(spark, 1, 2).crossJoin(spark.range(500)).repartition(8)
    busy = busy.withColumn("total_amount", F.col("id").cast("double")).drop("id")
    tables.write_silver(busy, name)
    assert len(spark.table(name).inputFiles()) == 2


def test_a_month_with_most_rows_is_split(spark, schema):
    name = f"{schema}.silver"
    busy = spark.range(0, 200_000, 1, numPartitions=16).select(
        F.rand(1).alias("total_amount"),
        F.lit(2023).alias("trip_year"),
        F.when(F.col("id") % 1000 == 0, F.col("id") % 3 + 1).otherwise(1).alias("trip_month"),
    )
    with applied(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"}):
        assert tables.write_silver(busy, name) == 200_000
    files = [f.split("trip_month=")[1][0] for f in spark.table(name).inputFiles()]
    assert files.count("1") >= 4
    assert files.count("2") == files.count("3") == 1


def test_refresh_replaces_only_the_given_months(spark, schema):
    name = f"{schema}.silver"
    tables.write_silver(months(spark, 1, 2, 3), name)
    tables.refresh_partitions(months(spark, 2, 5, amount=9.0), name)
    assert amounts(spark, name) == {1: 1.0, 2: 9.0, 3: 1.0, 5: 9.0}


def test_refresh_goes_by_column_name(spark, schema):
    name = f"{schema}.silver"
    tables.write_silver(months(spark, 1), name)
    fresh = months(spark, 1, amount=4.0)
    tables.refresh_partitions(fresh.select(*reversed(fresh.columns)), name)
    assert amounts(spark, name) == {1: 4.0}


def test_refresh_from_the_table_itself(spark, schema):
    """The new partitions are complete before they take the place of the old ones."""
    name = f"{schema}.silver"
    tables.write_silver(months(spark, 1, 2, 3), name)
    doubled = spark.table(name).filter("trip_month = 2").withColumn("total_amount", F.lit(2.0))
    tables.refresh_partitions(doubled, name)
    assert amounts(spark, name) == {1: 1.0, 2: 2.0, 3: 1.0}


def test_settings_come_back(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    with applied(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert spark.conf.get("spark.sql.session.timeZone") == before


def test_shuffle_grows_with_the_data():
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert number not in session_settings()
    scan = "spark.sql.files.maxPartitionBytes"
    megabyte, terabyte = 2**20, 2**40
    for total, least, partitions, merged, scanned in (
        (10, 200, 200, 64 * megabyte, 128 * megabyte),
        (terabyte, 200, 16_384, 64 * megabyte, 128 * megabyte),
        (100 * terabyte, 200, 20_000, 256 * megabyte, 1024 * megabyte),
        (100 * terabyte, 30_000, 30_000, 256 * megabyte, 1024 * megabyte),
    ):
        settings = session_settings(total, least)
        found = [int(settings[key]) for key in (number, size, scan)]
        assert found == [partitions, merged, scanned]


def test_gold_keeps_the_number_of_partitions_of_the_session(spark, lake, monkeypatch):
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    found = []
    real = pipeline.write_gold
    monkeypatch.setattr(
        pipeline, "write_gold", lambda *a: found.append(spark.conf.get(number, None)) or real(*a)
    )
    pipeline.run_all(spark, lake)
    assert found == [None, None]


def test_rows_without_a_pickup_land(spark, schema, tmp_path):
    """All rows are in bronze, and those without a pickup in no trusted month."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.withColumn(
        "l_shipdate", F.when(F.col("l_linenumber") > 1, F.col("l_shipdate"))
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    landing = adapters.write_landing(spark, str(tmp_path), adapters.LINEITEM)
    rows = read_landing(spark, landing)
    ingested = adapters.ingested_trips(spark, str(tmp_path), adapters.LINEITEM)
    assert rows.count() == ingested.count()
    undated = rows.filter("tpep_pickup_datetime is null")
    assert undated.count() == ingested.filter("tpep_pickup_datetime is null").count() > 0
    assert undated.select("_ref_year", "_ref_month").distinct().count() == 1
    assert refine(undated, adapters.LINEITEM.period).count() == 0


def test_the_hour_mart_is_named_by_its_month():
    assert pipeline.hour_mart(5) == "avg_passenger_count_by_hour_may"
    assert list(pipeline.default_marts(Period(2024, 1, 1), 1))[1].endswith("_by_hour_jan")


class SessionWith:
    """As much of a session as a scratch folder needs."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf |= {WAREHOUSE_DIR: settings.get("spark_sql_warehouse_dir")}


def test_scratch_is_below_the_shared_folder_and_fresh():
    session = SessionWith(spark_checkpoint_dir="hdfs://shared/tmp/", spark_master="yarn")
    one, two = (scratch_folder(session, "x") for _ in range(2))
    assert one.startswith("hdfs://shared/tmp/tripmart-x-") and one != two


def test_scratch_falls_back_on_the_warehouse():
    session = SessionWith(spark_sql_warehouse_dir="hdfs://shared/warehouse/")
    assert scratch_folder(session, "x").startswith("hdfs://shared/warehouse/scratch/tripmart-x-")


@pytest.mark.parametrize("warehouse", ["file:/home/x/spark-warehouse", "/home/x/spark-warehouse"])
def test_scratch_is_never_on_each_machine_of_a_cluster(warehouse):
    local = SessionWith(spark_sql_warehouse_dir=warehouse, spark_master="local[8]")
    assert scratch_folder(local, "x").startswith(f"{warehouse}/scratch/")
    for master in ({"spark_master": "yarn"}, {}):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(SessionWith(spark_sql_warehouse_dir=warehouse, **master), "x")


def test_names():
    plain = Lake("/landing")
    assert plain.bronze_table == "bronze.yellow_taxi_trips"
    named = Lake("/landing", catalog="main", location="/lake/")
    assert named.silver_table == "main.silver.yellow_taxi_trips"
    assert named.gold_table("m") == "main.gold.m"
    assert named.schema_location("gold") == "/lake/gold"


def test_pipeline(spark, lake):
    # The layers are in UTC, whatever the session is in.
    with applied(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        rows = pipeline.run_all(spark, lake)
    assert rows == {
        lake.bronze_table: 6,
        lake.silver_table: 2,
        pipeline.MONTH_MART: 2,
        pipeline.hour_mart(): 1,
    }
    bronze = spark.table(lake.bronze_table)
    assert bronze.columns[-4:] == ["_source_file", "_ingested_at", "_ref_year", "_ref_month"]
    month = spark.sql(sql.SERVE_MONTH, mart=spark.table(lake.gold_table(pipeline.MONTH_MART)))
    assert [tuple(r) for r in month.collect()] == [(2023, 4, 10.0), (2023, 5, 20.0)]
    hour = spark.sql(sql.SERVE_HOUR, mart=spark.table(lake.gold_table(pipeline.hour_mart())))
    assert [tuple(r) for r in hour.collect()] == [(7, BASE["passenger_count"])]
    extra = {"busiest": lambda silver: silver.groupBy("VendorID").count()}
    assert pipeline.build_gold(spark, lake, extra) == {"busiest": 1}
    assert spark.table(lake.gold_table("busiest")).first()["count"] == 2
    # A second run replaces everything.
    assert pipeline.run_all(spark, lake)[lake.silver_table] == 2
    assert spark.table(lake.bronze_table).count() == 6


def test_tasks_do_not_multiply_the_landing_files(spark, tmp_path):
    """Every task has rows of every month; they come together in one file per entry."""
    (
        spark.range(0, 1200, 1, 6)
        .selectExpr(
            "id as l_orderkey", "1 + id % 9 as l_suppkey", "cast(id % 7 as int) as l_linenumber",
            "cast(id as double) as l_quantity", "cast(id as double) as l_extendedprice",
            "'N' as l_returnflag",
            "cast(make_date(cast(1995 + id % 5 as int), cast(1 + id % 4 as int), 9) as timestamp_ntz)"
            " as l_shipdate",
        )
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    )
    landing = adapters.write_landing(spark, str(tmp_path), adapters.LINEITEM)
    again = adapters.write_landing(spark, str(tmp_path), adapters.LINEITEM, "VendorID <> 1")
    adapters.write_landing(spark, str(tmp_path), adapters.LINEITEM, "VendorID = 1", again)
    for folder, files in ((landing, 1), (again, 2)):
        entries = list(Path(folder).glob("file=*"))
        assert len(entries) == 20
        assert max(len(list(e.glob("*.parquet"))) for e in entries) <= files
        assert spark.read.option("basePath", folder).parquet(
            *(str(e) for e in entries if "1995" in e.name)
        ).count() == 240
