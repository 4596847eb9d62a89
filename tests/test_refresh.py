"""Runs that only do what is new, against full rebuilds."""

from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import raw_trips
from tripmart.config import Lake, Period
from tripmart.plans import pipeline


def trip(month, amount, day=3, **more):
    return {
        "tpep_pickup_datetime": datetime(2023, month, day, 7),
        "tpep_dropoff_datetime": datetime(2023, month, day, 8),
        "total_amount": float(amount),
    } | more


@pytest.fixture
def lake(spark, tmp_path):
    tag = abs(hash(str(tmp_path)))
    return Lake(
        f"{tmp_path}/landing",
        bronze_schema=f"bronze_{tag}",
        silver_schema=f"silver_{tag}",
        gold_schema=f"gold_{tag}",
        location=f"{tmp_path}/lake",
    )


def land(spark, lake, name, *trips, shape=lambda df: df, mode="errorifexists"):
    rows = shape(raw_trips(spark, *trips)).coalesce(1)
    rows.write.mode(mode).parquet(f"{lake.landing_path}/{name}.parquet")


def land_three(spark, lake):
    land(spark, lake, "trips_2023-01", trip(1, 10), trip(1, 10), trip(2, 11))
    land(spark, lake, "trips_2023-02", trip(2, 20), trip(3, 21, passenger_count=0.0))
    land(spark, lake, "trips_2023-03", trip(3, 30), trip(3, 31))


def contents(spark, lake):
    names = [lake.bronze_table, lake.silver_table]
    names += [lake.gold_table(name) for name in pipeline.default_marts()]
    tables = [spark.table(name).drop("_ingested_at") for name in names]
    return [
        sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
        for df in tables
    ]


def rebuilt(spark, lake, **options):
    """What a full run of the same landing files gives."""
    other = replace(
        lake,
        bronze_schema=f"{lake.bronze_schema}_full",
        silver_schema=f"{lake.silver_schema}_full",
        gold_schema=f"{lake.gold_schema}_full",
    )
    pipeline.run_all(spark, other, **options)
    return contents(spark, other)


def files(spark, name):
    spark.catalog.refreshTable(name)
    return {f: Path(f.removeprefix("file:")).stat().st_mtime_ns for f in spark.table(name).inputFiles()}


def kept_files(before, after):
    return {f.rsplit("/", 2)[1] for f in before if after.get(f) == before[f]}


def test_without_news_nothing_is_written(spark, lake):
    land_three(spark, lake)
    first = pipeline.refresh_all(spark, lake)
    assert first[lake.bronze_table] == 7 and first[lake.silver_table] == 5
    tables = [lake.bronze_table, lake.silver_table, lake.gold_table(pipeline.MONTH_MART), lake.ledger_table]
    before = [files(spark, t) for t in tables]
    assert pipeline.refresh_all(spark, lake) == {}
    assert [files(spark, t) for t in tables] == before
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_a_new_file_writes_its_months_alone(spark, lake):
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    before = files(spark, lake.bronze_table), files(spark, lake.silver_table)
    land(spark, lake, "trips_2023-04", trip(4, 40), trip(3, 39), trip(3, 30))
    written = pipeline.refresh_all(spark, lake)
    assert written[lake.bronze_table] == 3
    assert written[lake.silver_table] == 4  # three of March, one of April
    bronze, silver = files(spark, lake.bronze_table), files(spark, lake.silver_table)
    assert kept_files(before[0], bronze) == {f"_ref_month={m}" for m in (1, 2, 3)}
    assert kept_files(before[1], silver) == {"trip_month=1", "trip_month=2"}
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_a_second_file_of_a_month_and_one_that_grows(spark, lake):
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    land(spark, lake, "rerun_2023-02", trip(2, 22))
    land(spark, lake, "trips_2023-03", trip(5, 50), mode="append")
    written = pipeline.refresh_all(spark, lake)
    assert written[lake.bronze_table] == 6
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_a_file_that_is_replaced(spark, lake):
    """Event months of rows that are gone are computed again, and dropped when empty."""
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    land(spark, lake, "trips_2023-03", trip(4, 30), trip(1, 77), mode="overwrite")
    pipeline.refresh_all(spark, lake)
    months = {r.trip_month for r in spark.table(lake.silver_table).collect()}
    assert months == {1, 2, 4}
    shown = spark.sql(f"show partitions {lake.silver_table}").collect()
    assert sorted(r.partition for r in shown) == [f"trip_year=2023/trip_month={m}" for m in (1, 2, 4)]
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_a_file_that_is_gone(spark, lake):
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    folder = Path(lake.landing_path, "trips_2023-02.parquet")
    folder.rename(folder.with_name("_trips_2023-02.parquet"))
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 0
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_new_columns_and_types(spark, lake):
    """A subset of the columns fits; a new one, or text for numbers, takes a rebuild."""
    with_fee = lambda df: df.withColumn("fee", F.lit(2).cast("bigint"))
    land(spark, lake, "trips_2023-01", trip(1, 10), shape=with_fee)
    pipeline.run_all(spark, lake)
    land(spark, lake, "trips_2023-02", trip(2, 20))
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 1
    assert contents(spark, lake) == rebuilt(spark, lake)
    land(spark, lake, "trips_2023-03", trip(3, 30), shape=lambda df: df.withColumn("fee", F.lit("2x")))
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 3
    land(spark, lake, "trips_2023-04", trip(4, 40), shape=with_fee)
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 1
    assert {r.fee for r in spark.table(lake.bronze_table).collect()} == {"2", None, "2x"}
    land(spark, lake, "trips_2023-05", trip(5, 40), shape=lambda df: df.withColumn("tip", F.lit(1.0)))
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 5
    assert contents(spark, lake) == rebuilt(spark, lake)


def test_other_terms_take_a_rebuild(spark, lake):
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    period = Period(2023, 2, 3)
    assert pipeline.refresh_all(spark, lake, period)[lake.bronze_table] == 7
    assert pipeline.refresh_all(spark, lake, period) == {}
    assert {r.trip_month for r in spark.table(lake.silver_table).collect()} == {2, 3}


@pytest.mark.parametrize("step", ["replace_partitions", "build_gold", "_write_ledger"])
def test_a_run_that_fails_is_completed_by_the_next(spark, lake, monkeypatch, step):
    """Wherever it stops, also between bronze and silver."""
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    land(spark, lake, "trips_2023-03", trip(4, 30), trip(1, 77), mode="overwrite")
    real, calls = getattr(pipeline, step), []

    def failing(*args, **options):
        calls.append(args)
        if step == "replace_partitions" and len(calls) == 1:  # bronze; silver fails
            return real(*args, **options)
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline, step, failing)
    with pytest.raises(RuntimeError, match="stopped"):
        pipeline.refresh_all(spark, lake)
    monkeypatch.setattr(pipeline, step, real)
    assert pipeline.refresh_all(spark, lake)
    assert contents(spark, lake) == rebuilt(spark, lake)
    assert pipeline.refresh_all(spark, lake) == {}


def test_a_rebuild_that_fails_is_not_trusted(spark, lake, monkeypatch):
    land_three(spark, lake)
    pipeline.run_all(spark, lake)
    land(spark, lake, "trips_2023-04", trip(4, 40))

    def failing(*args, **options):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "build_silver", failing)
        with pytest.raises(RuntimeError, match="stopped"):
            pipeline.run_all(spark, lake)
    assert pipeline.refresh_all(spark, lake)[lake.bronze_table] == 8
    assert contents(spark, lake) == rebuilt(spark, lake)
