"""Landing files with drifting schemas."""

import math
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import initial_plan, raw_trips
from tripmart.config import Period
from tripmart.functions.frames import normalize_numerics, stamp_ingestion, union_all
from tripmart.operators.completeness import missing_months
from tripmart.sources import landing as landing_module
from tripmart.sources.landing import landing_entries, read_landing

MONTHS = {
    1: lambda df: df.withColumn("airport_fee", F.lit(1).cast("bigint")),
    2: lambda df: df.withColumn("airport_fee", F.lit(1.25)).withColumn(
        "passenger_count", F.col("passenger_count").cast("bigint")
    ),
    3: lambda df: df,
    4: lambda df: df.withColumn("Airport_fee", F.lit("2.50").cast("decimal(10,2)")),
    5: lambda df: df.withColumn("airport_fee", F.lit(0.5)).withColumn("note", F.lit("n")),
}


@pytest.fixture
def landing(spark, tmp_path):
    """One folder per month; the number of rows is the number of the month."""
    for month, shape in MONTHS.items():
        rows = raw_trips(spark, *({"total_amount": float(i)} for i in range(month)))
        shape(rows).write.parquet(f"{tmp_path}/trips_2023-{month:02d}.parquet")
    return str(tmp_path)


def test_one_scan_over_all_months_fails(spark, landing):
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH"):
        spark.read.parquet(
            f"{landing}/trips_2023-01.parquet", f"{landing}/trips_2023-02.parquet"
        ).collect()


def test_all_months_in_uniform_types(spark, landing):
    df = read_landing(spark, landing)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types == {
        "VendorID": "double",
        "passenger_count": "double",
        "total_amount": "double",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "airport_fee": "double",
        "_source_file": "string",
        "_ref_year": "int",
        "_ref_month": "int",
        "note": "string",
    }
    rows = df.collect()
    assert len(rows) == 15
    fees = {1: 1.0, 2: 1.25, 3: None, 4: 2.5, 5: 0.5}
    for row in rows:
        assert row._ref_year == 2023
        assert row.airport_fee == fees[row._ref_month]
        assert row.note == ("n" if row._ref_month == 5 else None)
        assert row._source_file == f"{landing}/trips_2023-{row._ref_month:02d}.parquet"


@pytest.mark.parametrize("spelling", ["{}", "{}/", "file:{}", "file://{}/"])
def test_any_spelling_of_the_folder(spark, landing, spelling):
    folder = spelling.format(landing)
    rows = read_landing(spark, folder).select("_source_file", "_ref_month")
    assert {tuple(row) for row in rows.collect()} == {
        (f"{folder.rstrip('/')}/trips_2023-{month:02d}.parquet", month) for month in MONTHS
    }


def test_missing_month(spark, landing):
    df = read_landing(spark, landing).filter("_ref_month <> 3")
    assert [tuple(r) for r in missing_months(df, Period(2023, 1, 5)).collect()] == [(2023, 3)]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_landing(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_landing(spark, str(tmp_path / "nowhere"))


@pytest.mark.parametrize(
    "name", ["trips_2023.parquet", "trips_2023-1.parquet", "trips-2023-01.parquet"]
)
def test_names_without_a_month(spark, tmp_path, name):
    raw_trips(spark, {}).write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(ValueError, match="YYYY-MM"):
        read_landing(spark, str(tmp_path))


def test_single_files_and_nothing_below(spark, tmp_path):
    """Files land as they are; other names, hidden and deeper files are not read."""
    raw_trips(spark, {}).coalesce(1).write.parquet(f"{tmp_path}/made")
    (part,) = Path(tmp_path, "made").glob("*.parquet")
    landing = tmp_path / "landing"
    for name in (
        "trips_2023-01.parquet",
        "old/trips_2022-01.parquet",
        "notes_2023-01.txt",
        "_trips_2023-02.parquet",
        ".trips_2023-03.parquet",
    ):
        target = landing / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(part.read_bytes())
    rows = read_landing(spark, f"{landing}/").collect()
    assert [(r._ref_year, r._ref_month) for r in rows] == [(2023, 1)]
    assert rows[0]._source_file == f"{landing}/trips_2023-01.parquet"


def test_several_files_of_one_month(spark, tmp_path):
    """One scan where their types agree, and each row keeps its own file."""
    names = ["a_2023-01.parquet", "b c+d_2023-01.parquet", "e_2023-01.parquet"]
    for amount, name in enumerate(names):
        raw_trips(spark, {"total_amount": float(amount)}).write.parquet(f"{tmp_path}/{name}")
    drifted = raw_trips(spark, {"total_amount": 9.0}).withColumn("VendorID", F.lit(7.0))
    drifted.write.parquet(f"{tmp_path}/f_2023-01.parquet")
    df = read_landing(spark, str(tmp_path))
    found = {row.total_amount: row._source_file for row in df.collect()}
    assert found == {
        **{float(i): f"{tmp_path}/{name}" for i, name in enumerate(names)},
        9.0: f"{tmp_path}/f_2023-01.parquet",
    }


def test_entries_sort_by_month(spark, tmp_path):
    for name in ("z_2022-12.parquet", "a_2023-02.parquet", "a_2023-01.parquet"):
        raw_trips(spark, {}).write.parquet(f"{tmp_path}/{name}")
    assert [e.period for e in landing_entries(spark, str(tmp_path))] == [
        (2022, 12),
        (2023, 1),
        (2023, 2),
    ]


def test_part_files_with_more_columns(spark, tmp_path):
    """A folder written twice, the second time with a new column, loses nothing."""
    target = f"{tmp_path}/trips_2023-01.parquet"
    raw_trips(spark, {}).write.parquet(target)
    raw_trips(spark, {}).withColumn("tip", F.lit(2)).write.mode("append").parquet(target)
    tips = [row.tip for row in read_landing(spark, str(tmp_path)).collect()]
    assert sorted(tips, key=str) == [2.0, None]


def test_entries_of_one_schema_share_a_scan(spark, landing):
    for month in (1, 2):
        raw_trips(spark, {"total_amount": 100.0 + month}).write.parquet(
            f"{landing}/again_2023-{month:02d}.parquet"
        )
    df = read_landing(spark, landing)
    assert initial_plan(df).count("FileScan") <= 5
    found = {
        (row._source_file.removeprefix(landing), row._ref_year, row._ref_month)
        for row in df.collect()
    }
    trips = {(f"/trips_2023-0{m}.parquet", 2023, m) for m in MONTHS}
    assert found == trips | {(f"/again_2023-0{m}.parquet", 2023, m) for m in (1, 2)}


def test_which_numbers_become_double(spark):
    df = spark.sql(
        "select cast(1 as tinyint) as b, cast(1 as smallint) as s, 1 as i, 1L as l, "
        "cast(1 as decimal(9,2)) as d, cast(1 as float) as f, 1D as x, 'a' as t, true as o, "
        "date'2023-01-01' as day, named_struct('n', 1) as nested, 1 as `a.b`, 2 as `c``d`"
    )
    types = {f.name: f.dataType.simpleString() for f in normalize_numerics(df).schema}
    assert types == {
        "b": "tinyint",
        "s": "double",
        "i": "double",
        "l": "double",
        "d": "double",
        "f": "float",
        "x": "double",
        "t": "string",
        "o": "boolean",
        "day": "date",
        "nested": "struct<n:int>",
        "a.b": "double",
        "c`d": "double",
    }


def test_wide_keys_can_be_kept(spark):
    df = spark.createDataFrame([(2**53 + 1,)], "k bigint")
    assert normalize_numerics(df).first().k == 2**53
    assert normalize_numerics(df, keep={"k"}).first().k == 2**53 + 1


def test_times_with_and_without_a_zone(spark, tmp_path):
    """Both kinds end up as instants, read in the zone of the session."""
    for month, kind in ((1, "timestamp_ntz"), (2, "timestamp"), (3, "timestamp_ntz")):
        pickup = datetime(2023, month, 5, 6, 7)
        trips = raw_trips(spark, {"tpep_pickup_datetime": pickup})
        trips.withColumn(
            "tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast(kind)
        ).write.parquet(f"{tmp_path}/trips_2023-{month:02d}.parquet")
    df = read_landing(spark, str(tmp_path))
    assert dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp"
    found = df.selectExpr("_ref_month", "cast(tpep_pickup_datetime as timestamp_ntz) as t")
    assert {tuple(row) for row in found.collect()} == {
        (month, datetime(2023, month, 5, 6, 7)) for month in (1, 2, 3)
    }


def test_names_to_keep_go_without_regard_to_case(spark, landing):
    df = spark.createDataFrame([(2**53 + 1,)], "VendorID bigint")
    assert normalize_numerics(df, keep={"vendorid"}).first().VendorID == 2**53 + 1
    with pytest.raises(ValueError, match="nowhere"):
        read_landing(spark, landing, keep={"nowhere"})


def test_a_column_that_is_text_in_any_month_is_text_in_all(spark, tmp_path):
    codes = {1: "'2x'", 2: "7L", 3: "cast(1.50 as decimal(9,2))"}
    for month in (1, 2, 3, 4):
        trips = raw_trips(spark, {})
        if month in codes:
            trips = trips.withColumn("code", F.expr(codes[month]))
        trips.write.parquet(f"{tmp_path}/trips_2023-{month:02d}.parquet")
    df = read_landing(spark, str(tmp_path))
    assert {(r._ref_month, r.code) for r in df.collect()} == {
        (1, "2x"), (2, "7"), (3, "1.50"), (4, None),
    }


@pytest.mark.parametrize("month", ["00", "13"])
def test_months_are_months(spark, tmp_path, month):
    raw_trips(spark, {}).write.parquet(f"{tmp_path}/trips_2023-{month}.parquet")
    with pytest.raises(ValueError, match="YYYY-MM"):
        read_landing(spark, str(tmp_path))


@pytest.mark.parametrize("months", [12, 48])
def test_schemas_take_a_job_for_each_year(spark, tmp_path, monkeypatch, months):
    """And more only where types differ within a year."""
    for i in range(months):
        trips = raw_trips(spark, {}).withColumn("fee", F.lit(1).cast("bigint" if i // 12 % 2 else "double"))
        trips.coalesce(1).write.parquet(f"{tmp_path}/trips_{2020 + i // 12}-{i % 12 + 1:02d}.parquet")
    entries = landing_entries(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"schemas-{months}", "")
    monkeypatch.setattr(landing_module, "_at_once", lambda f, items: list(map(f, items)))
    runs = landing_module.merged_schemas(spark, entries)
    assert len(tracker.getJobIdsForGroup(f"schemas-{months}")) == len(runs) == months // 12
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_wide_keys_of_landing_files_can_be_kept(spark, tmp_path):
    for month, kind in ((1, "bigint"), (2, "int")):
        trip = raw_trips(spark, {"VendorID": 2**53 + 1 if month == 1 else 5})
        trip.withColumn("VendorID", F.col("VendorID").cast(kind)).write.parquet(
            f"{tmp_path}/trips_2023-{month:02d}.parquet"
        )
    df = read_landing(spark, str(tmp_path), keep={"VendorID"})
    assert {row.VendorID for row in df.collect()} == {2**53 + 1, 5}
    assert dict(df.dtypes)["VendorID"] == "bigint"


def test_union_fills_missing_columns_and_keeps_copies(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("x", 1), ("x", 1)], "T string, n int")
    c = spark.createDataFrame([(math.pi,)], "p double")
    rows = union_all([a, b, c]).collect()
    assert [tuple(r) for r in rows] == [(1, "x", None)] * 3 + [(None, None, math.pi)]


def test_one_ingestion_time_per_run(spark):
    stamped = stamp_ingestion(spark.range(100).repartition(4))
    assert stamped.select("_ingested_at").distinct().count() == 1
    assert stamped.filter("_ingested_at is null").count() == 0


class WithoutHandles:
    """A session that has none of the JVM."""

    def __init__(self, spark):
        self._spark = spark

    def __getattr__(self, name):
        if name in ("_jvm", "_jsc", "_jsparkSession", "sparkContext"):
            raise AttributeError(f"no {name} here")
        return getattr(self._spark, name)


def test_landing_needs_no_jvm_handle(spark, landing):
    assert read_landing(WithoutHandles(spark), landing).count() == 15


def test_listing_names_sizes_and_times(spark, landing):
    """Of all files below an entry, and by Spark's own reader."""
    entries = landing_entries(spark, landing)
    assert [e.month for e in entries] == list(MONTHS)
    for entry in entries:
        files = [f for f in Path(entry.path).iterdir() if f.suffix == ".parquet" and f.name[0] not in "._"]
        assert entry.size == sum(f.stat().st_size for f in files)
        assert abs(entry.modified - max(f.stat().st_mtime for f in files) * 1e6) < 2e6


def test_listing_below_a_folder_named_like_an_entry(spark, tmp_path):
    folder = f"{tmp_path}/old_2020-01.parquet/in"
    for name in ("x.parquet.copy_2023-02.parquet", "a_2023-01.parquet"):
        raw_trips(spark, {}).write.parquet(f"{folder}/{name}")
    found = [(e.month, e.name) for e in landing_entries(spark, folder)]
    assert found == [(1, "a_2023-01.parquet"), (2, "x.parquet.copy_2023-02.parquet")]
    assert {r._source_file for r in read_landing(spark, folder).collect()} == {
        f"{folder}/{name}" for _, name in found
    }


def test_columns_can_be_made_text(spark, landing):
    df = read_landing(spark, landing, as_text={"AIRPORT_FEE"})
    assert dict(df.dtypes)["airport_fee"] == "string"
    assert {r.airport_fee for r in df.collect()} == {"1", "1.25", None, "2.50", "0.5"}
