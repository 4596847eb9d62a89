"""What the plans must look like to hold at a large scale."""

import pytest

import __spark_entry__ as contract
from helpers import (
    count_in_plan,
    formatted_plan,
    initial_plan,
    scan_lines,
    scanned_rows,
    shuffled_rows,
)
from tripmart.adapters import LINEITEM
from tripmart.functions.frames import stamp_ingestion
from tripmart.operators import marts, profile
from tripmart.operators.completeness import missing_months
from tripmart.operators.refine import refine
from tripmart.sources.landing import landing_entries, read_landing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return contract._lake(spark, SF_DIR, LINEITEM)


@pytest.fixture(scope="module")
def bronze(spark, lake):
    return spark.table(lake.bronze_table)


@pytest.fixture(scope="module")
def silver(spark, lake):
    return spark.table(lake.silver_table)


def test_refine_filters_in_the_scan_and_shuffles_once(bronze):
    df = refine(bronze, LINEITEM.period)
    (pushed,) = scan_lines(df, "PushedFilters")
    for column in ("passenger_count", "total_amount", "tpep_pickup_datetime"):
        assert f"GreaterThanOrEqual({column}," in pushed
    assert "LessThan(tpep_pickup_datetime," in pushed
    (read,) = scan_lines(df, "ReadSchema")
    assert "airport_fee" not in read and "note" not in read
    assert count_in_plan(df, "Exchange") == 1
    assert count_in_plan(df, "HashAggregate") == 2  # copies meet before the shuffle


def test_event_month_stays_out_of_the_shuffle(bronze):
    plan = formatted_plan(refine(bronze, LINEITEM.period))
    exchange = plan[plan.index(") Exchange\n") :].split("\n\n")[0]
    assert "trip_year" not in exchange


def test_hour_mart_reads_one_partition(silver):
    df = marts.passengers_by_hour(silver, 1995, 5)
    (pruned,) = scan_lines(df, "PartitionFilters")
    assert "trip_month" in pruned and "= 5" in pruned
    assert scan_lines(df, "ReadSchema") == [
        "struct<passenger_count:int,tpep_pickup_datetime:timestamp>"
    ]


def test_month_marts_read_one_column(silver):
    for mart in (marts.amount_by_month, marts.amount_and_trips_by_month):
        assert scan_lines(mart(silver), "ReadSchema") == ["struct<total_amount:double>"]


def test_volumes_read_no_column(bronze, silver):
    by_month = profile.rows_per(silver, "trip_year", "trip_month")
    by_file = profile.rows_per(bronze, "_ref_year", "_ref_month")
    for df in (by_month, by_file, profile.row_count(silver)):
        assert scan_lines(df, "ReadSchema") == ["struct<>"]


def test_missing_months_prune_and_broadcast(bronze):
    df = missing_months(bronze)
    (pruned,) = scan_lines(df, "PartitionFilters")
    assert "_ref_year" in pruned and "_ref_month" in pruned
    assert scan_lines(df, "ReadSchema") == ["struct<>"]
    assert "BroadcastHashJoin" in initial_plan(df) and "LeftAnti" in initial_plan(df)


def test_top_trips_are_no_global_sort(silver):
    for df in (profile.top_trips(silver), profile.top_trips_stats(silver)):
        assert "TakeOrderedAndProject" in initial_plan(df)
        assert "rangepartitioning" not in initial_plan(df)


def final_plan(df):
    df.collect()
    plan = initial_plan(df)
    # Subqueries carry plans of their own; drop what they started from.
    return plan[: plan.rindex("== Initial Plan ==")]


def test_histogram_joins_nothing_and_finds_its_bounds_once(silver):
    df = profile.histogram(profile.in_band(silver))
    plan = initial_plan(df)
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert final_plan(df).count("ReusedSubquery") >= 1
    for pushed in scan_lines(df, "PushedFilters"):
        assert "GreaterThan(total_amount,0.0)" in pushed and "LessThan(total_amount" in pushed


def test_summary_takes_few_shuffles(bronze):
    """One for duplicates, which both passes use, and three of a few rows."""
    df = profile.summary(refine(bronze, LINEITEM.period))
    plan = final_plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    kept = refine(bronze, LINEITEM.period).count()
    written = shuffled_rows(df)
    assert len(written) <= 4
    assert sum(n > kept / 4 for n in written) <= 1


def test_summary_reads_its_input_twice_at_most(bronze, silver):
    assert sum(scanned_rows(profile.summary(silver))) <= 2 * silver.count()
    # Behind a shuffle, once: both passes read what it wrote.
    trips = refine(bronze, LINEITEM.period)
    assert sum(scanned_rows(profile.summary(trips))) == sum(scanned_rows(trips))


def test_entries_share_a_scan_per_schema(spark):
    landing = contract._landing(spark, SF_DIR, LINEITEM)
    entries = landing_entries(spark, landing)
    scans = initial_plan(read_landing(spark, landing)).count("FileScan")
    assert scans == 5 < len(entries)


def test_ingestion_shuffles_nothing(spark):
    landing = contract._landing(spark, SF_DIR, LINEITEM)
    assert "Exchange" not in initial_plan(stamp_ingestion(read_landing(spark, landing)))


@pytest.mark.parametrize("name", contract._QUERIES)
def test_no_python_and_no_cross_join_anywhere(spark, name):
    plan = initial_plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
