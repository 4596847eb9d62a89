"""

Queries read the test tables as trips (see ``tripmart.adapters``). Those on stored
tables first run the pipeline into a fresh scratch folder, once per session and input.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tripmart import adapters
from tripmart.adapters import EVENTS, LINEITEM, Adapter, ingested_trips, raw_rows
from tripmart.config import TRIP_COLUMNS, Lake, Period
from tripmart.functions.columns import named
from tripmart.functions.frames import normalize_numerics, stamp_ingestion, union_all
from tripmart.operators import marts, profile
from tripmart.operators.completeness import missing_months
from tripmart.operators.refine import (
    add_event_month,
    cast_trip_types,
    deduplicate,
    filter_valid,
    refine,
    rename_snake_case,
    select_required,
)
from tripmart.plans import pipeline, sql
from tripmart.sources import tables
from tripmart.sources.landing import read_landing
from tripmart.sources.scratch import scratch_folder

try:  # the corpus operators are an optional part, and so are the packages that they need
    import corpus_pipeline
    from tripmart.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name.startswith("tripmart") and missing.name != "tripmart.llm":
        raise
    logging.getLogger(__name__).warning("no corpus queries: %s", missing)
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"

# The last year of the input, which ends before its last month.
OPEN_YEAR = Period(2001, 1, 12)


# -- Inputs -----------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str, adapter: Adapter) -> DataFrame:
    return refine(ingested_trips(spark, sf_dir, adapter), adapter.period)


_landings: dict[tuple, str] = {}
_lakes: dict[tuple, Lake] = {}


def _key(spark: SparkSession, *rest: str) -> tuple:
    return spark.conf.get("spark.app.id"), *rest


def _landing(spark: SparkSession, sf_dir: str, adapter: Adapter) -> str:
    key = _key(spark, sf_dir, adapter.table)
    if key not in _landings:
        _landings[key] = adapters.write_landing(spark, sf_dir, adapter)
    return _landings[key]


def _fresh_lake(spark: SparkSession, landing_path: str) -> Lake:
    """Tables of their own, in schemas with names of their own."""
    tag = uuid4().hex
    return Lake(
        landing_path,
        bronze_schema=f"bronze_{tag}",
        silver_schema=f"silver_{tag}",
        gold_schema=f"gold_{tag}",
        location=scratch_folder(spark, "tables"),
    )


def _lake(spark: SparkSession, sf_dir: str, adapter: Adapter) -> Lake:
    """Every layer, built by one run of the pipeline."""
    key = _key(spark, sf_dir, adapter.table)
    if key not in _lakes:
        lake = _fresh_lake(spark, _landing(spark, sf_dir, adapter))
        pipeline.run_all(spark, lake, adapter.period, adapter.hour_month)
        _lakes[key] = lake
    return _lakes[key]


# What lands after the first run: a month, and part of another one.
_LATE = "month(tpep_pickup_datetime) = 3 or month(tpep_pickup_datetime) = 5 and VendorID % 7 = 0"


def _refreshed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Every layer, built without the late rows and brought up to date when they landed."""
    key = _key(spark, sf_dir, "refreshed")
    if key not in _lakes:
        early = f"not coalesce({_LATE}, false)"
        landing = adapters.write_landing(spark, sf_dir, LINEITEM, early)
        lake = _fresh_lake(spark, landing)
        terms = (LINEITEM.period, LINEITEM.hour_month)
        pipeline.refresh_all(spark, lake, *terms)
        adapters.write_landing(spark, sf_dir, LINEITEM, _LATE, landing)
        pipeline.refresh_all(spark, lake, *terms)
        _lakes[key] = lake
    return _lakes[key]


def _own_table(spark: SparkSession, name: str) -> str:
    """A table of one query, which replaces it on every run; one schema per session."""
    key = _key(spark)
    if key not in _lakes:
        _lakes[key] = lake = _fresh_lake(spark, "")
        tables.ensure_schema(spark, lake.gold_schema, lake.schema_location(lake.gold_schema))
    return _lakes[key].gold_table(name)


# -- Outputs ----------------------------------------------------------------------


def _wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, which other engines compare as they are."""
    return df.select(
        *(
            named(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else named(f.name)
            for f in df.schema.fields
        )
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, because the order of summation may differ."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _entry_name(df: DataFrame) -> DataFrame:
    """The name of the landing entry in place of its path, which differs per run."""
    return df.withColumn("_source_file", F.substring_index("_source_file", "/", -1))


# -- Queries ----------------------------------------------------------------------


def _scan_parquet(spark, sf_dir):
    return raw_rows(spark, sf_dir, LINEITEM).select(*TRIP_COLUMNS)


def _read_landing(spark, sf_dir):
    return _entry_name(read_landing(spark, _landing(spark, sf_dir, LINEITEM)))


def _scan_table(spark, sf_dir):
    return tables.read_table(spark, _lake(spark, sf_dir, LINEITEM).silver_table)


def _bronze_table(spark, sf_dir):
    return tables.read_table(spark, _lake(spark, sf_dir, LINEITEM).bronze_table)


_PREVIEWED = (
    "_source_file", *TRIP_COLUMNS, "airport_fee", "note", "code", "_ref_year", "_ref_month",
)


def _preview(spark, sf_dir):
    rows = _entry_name(_bronze_table(spark, sf_dir)).select(*_PREVIEWED)
    return tables.preview(rows, order_by=_PREVIEWED)


def _missing_months(spark, sf_dir):
    return missing_months(_bronze_table(spark, sf_dir), OPEN_YEAR)


def _normalize_numeric(spark, sf_dir):
    return normalize_numerics(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _tag_source(spark, sf_dir):
    return profile.rows_per(_read_landing(spark, sf_dir), "_source_file", "_ref_year", "_ref_month")


def _ingestion_ts(spark, sf_dir):
    stamped = stamp_ingestion(ingested_trips(spark, sf_dir, EVENTS))
    return stamped.select(*TRIP_COLUMNS, F.col("_ingested_at").isNotNull().alias("stamped"))


def _union_by_name(spark, sf_dir):
    flagged = raw_rows(spark, sf_dir, LINEITEM).select(F.col("flag").alias("note"), *TRIP_COLUMNS)
    with_fee = raw_rows(spark, sf_dir, EVENTS).select(
        *TRIP_COLUMNS, F.col("fee").alias("airport_fee")
    )
    return union_all([flagged, with_fee])


def _select_required(spark, sf_dir):
    return select_required(raw_rows(spark, sf_dir, EVENTS))


def _cast_types(spark, sf_dir):
    fractional = ingested_trips(spark, sf_dir, EVENTS).withColumn(
        "passenger_count", F.col("total_amount")
    )
    return cast_trip_types(fractional)


def _partition_cols(spark, sf_dir):
    return add_event_month(ingested_trips(spark, sf_dir, LINEITEM))


def _snake_case(spark, sf_dir):
    return rename_snake_case(_silver(spark, sf_dir, EVENTS))


def _quality_filter(spark, sf_dir):
    typed = cast_trip_types(ingested_trips(spark, sf_dir, EVENTS))
    return filter_valid(add_event_month(typed), EVENTS.period)


def _dedup(spark, sf_dir):
    return deduplicate(ingested_trips(spark, sf_dir, LINEITEM))


def _silver_events(spark, sf_dir):
    return _silver(spark, sf_dir, EVENTS)


def _outlier_band(spark, sf_dir):
    return profile.in_band(_silver_events(spark, sf_dir)).select("total_amount")


def _gold_month(spark, sf_dir):
    return marts.amount_by_month(_silver(spark, sf_dir, LINEITEM))


def _gold_hour(spark, sf_dir):
    silver = _silver_events(spark, sf_dir)
    return marts.passengers_by_hour(silver, EVENTS.period.year, EVENTS.hour_month)


def _gold_month_sql(spark, sf_dir):
    return spark.sql(sql.AMOUNT_BY_MONTH, silver=_silver(spark, sf_dir, LINEITEM))


def _gold_hour_sql(spark, sf_dir):
    month = {"year": EVENTS.period.year, "month": EVENTS.hour_month}
    return spark.sql(sql.PASSENGERS_BY_HOUR, month, silver=_silver_events(spark, sf_dir))


def _month_avg_count(spark, sf_dir):
    return marts.amount_and_trips_by_month(_silver(spark, sf_dir, LINEITEM))


def _hour_avg_count(spark, sf_dir):
    silver = _silver_events(spark, sf_dir)
    return marts.passengers_and_trips_by_hour(silver, EVENTS.period.year, EVENTS.hour_month)


def _volume_by_month(spark, sf_dir):
    return profile.rows_per(_silver(spark, sf_dir, LINEITEM), "trip_year", "trip_month")


def _bronze_volume(spark, sf_dir):
    return profile.rows_per(_bronze_table(spark, sf_dir), "_ref_year", "_ref_month")


def _passenger_dist(spark, sf_dir):
    return profile.rows_per(_silver_events(spark, sf_dir), "passenger_count")


def _day_of_week(spark, sf_dir):
    return _rounded(profile.trips_by_weekday(_silver_events(spark, sf_dir)), "avg_amount")


def _summary_stats(spark, sf_dir):
    return _rounded(profile.summary(_silver_events(spark, sf_dir)), *profile.SUMMARY_COLUMNS)


def _histogram(spark, sf_dir):
    return profile.histogram(profile.in_band(_silver_events(spark, sf_dir)))


def _row_count(spark, sf_dir):
    return profile.row_count(_silver_events(spark, sf_dir))


def _period_bounds(spark, sf_dir):
    return profile.period_bounds(_silver_events(spark, sf_dir))


def _layer_counts(spark, sf_dir):
    return spark.sql(
        sql.LAYER_COUNTS, bronze=_bronze_table(spark, sf_dir), silver=_scan_table(spark, sf_dir)
    )


def _top10_amount(spark, sf_dir):
    return profile.top_trips(_silver_events(spark, sf_dir))


def _top10_stats(spark, sf_dir):
    stats = profile.top_trips_stats(_silver_events(spark, sf_dir))
    return _rounded(stats, "avg_amount", "avg_passengers")


def _serve_month(spark, sf_dir):
    mart = _lake(spark, sf_dir, LINEITEM).gold_table(pipeline.MONTH_MART)
    return spark.sql(sql.SERVE_MONTH, mart=tables.read_table(spark, mart))


def _serve_hour(spark, sf_dir):
    mart = _lake(spark, sf_dir, EVENTS).gold_table(pipeline.hour_mart(EVENTS.hour_month))
    return spark.sql(sql.SERVE_HOUR, mart=tables.read_table(spark, mart))


def _bronze(spark, sf_dir):
    return _entry_name(_bronze_table(spark, sf_dir)).drop("_ingested_at")


def _bronze_roundtrip(spark, sf_dir):
    name = _own_table(spark, "bronze_trips")
    landed = read_landing(spark, _landing(spark, sf_dir, EVENTS))
    tables.write_bronze(stamp_ingestion(landed), name)
    return _entry_name(tables.read_table(spark, name)).drop("_ingested_at")


def _silver_roundtrip(spark, sf_dir):
    name = _own_table(spark, "silver_trips")
    tables.write_silver(_silver_events(spark, sf_dir), name)
    return tables.read_table(spark, name)


def _gold_roundtrip(spark, sf_dir):
    name = _own_table(spark, "gold_hours")
    tables.write_gold(_gold_hour(spark, sf_dir), name)
    return tables.read_table(spark, name)


def _partition_refresh(spark, sf_dir):
    """March is recomputed with doubled amounts; the other months stay as they are."""
    name = _own_table(spark, "refreshed_trips")
    silver = _silver(spark, sf_dir, LINEITEM)
    tables.write_silver(silver, name)
    march = silver.filter("trip_month = 3").withColumn("total_amount", F.col("total_amount") * 2)
    tables.refresh_partitions(march, name)
    return tables.read_table(spark, name)


def _refreshed_bronze(spark, sf_dir):
    bronze = tables.read_table(spark, _refreshed_lake(spark, sf_dir).bronze_table)
    return _entry_name(bronze).drop("_ingested_at")


def _refreshed_silver(spark, sf_dir):
    return tables.read_table(spark, _refreshed_lake(spark, sf_dir).silver_table)


def _refreshed_month(spark, sf_dir):
    mart = _refreshed_lake(spark, sf_dir).gold_table(pipeline.MONTH_MART)
    return spark.sql(sql.SERVE_MONTH, mart=tables.read_table(spark, mart))


_QUERIES: dict[str, Query] = {
    "scan_parquet": _scan_parquet,
    "read_landing": _read_landing,
    "scan_table": _scan_table,
    "preview_10": _preview,
    "missing_months": _missing_months,
    "normalize_numeric": _normalize_numeric,
    "tag_source": _tag_source,
    "ingestion_ts": _ingestion_ts,
    "union_by_name": _union_by_name,
    "select_required": _select_required,
    "cast_types": _cast_types,
    "partition_cols": _partition_cols,
    "snake_case": _snake_case,
    "quality_filter": _quality_filter,
    "dedup": _dedup,
    "silver": _silver_events,
    "outlier_band": _outlier_band,
    "gold_month": _gold_month,
    "gold_hour": _gold_hour,
    "gold_month_sql": _gold_month_sql,
    "gold_hour_sql": _gold_hour_sql,
    "month_avg_count": _month_avg_count,
    "hour_avg_count": _hour_avg_count,
    "volume_by_month": _volume_by_month,
    "bronze_volume": _bronze_volume,
    "passenger_dist": _passenger_dist,
    "day_of_week": _day_of_week,
    "summary_stats": _summary_stats,
    "histogram": _histogram,
    "row_count": _row_count,
    "period_bounds": _period_bounds,
    "layer_counts": _layer_counts,
    "top10_amount": _top10_amount,
    "top10_stats": _top10_stats,
    "serve_month": _serve_month,
    "serve_hour": _serve_hour,
    "bronze": _bronze,
    "bronze_roundtrip": _bronze_roundtrip,
    "silver_roundtrip": _silver_roundtrip,
    "gold_roundtrip": _gold_roundtrip,
    "partition_refresh": _partition_refresh,
    "refreshed_bronze": _refreshed_bronze,
    "refreshed_silver": _refreshed_silver,
    "refreshed_month": _refreshed_month,
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The frame runs after this returns, so the zone stays as the results need it.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _wall_clock(query(spark, str(sf_dir).rstrip("/")))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Landing files to the hourly answer, through every layer."""
    return queries()["serve_hour"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """Every query by name; each takes a session and a folder of test tables."""
    found = dict(_QUERIES)
    if corpus:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _registered(query) for name, query in found.items()}


# -- SQL counterparts -------------------------------------------------------------

_TRIP_LIST = ", ".join(TRIP_COLUMNS)


def _with_bronze(adapter: Adapter, select: str) -> str:
    """``raw`` is the adapter's rows; ``bronze`` adds the slice ingested twice."""
    return f"""
with raw as ({adapter.raw_sql()}),
ingested as (select *, 'trips' as prefix from raw
             union all select *, 'rerun' from raw where VendorID % 10 = 0),
bronze as (select {_TRIP_LIST} from ingested)
{select}"""


def _with_silver(adapter: Adapter, select: str) -> str:
    period = adapter.period
    return _with_bronze(
        adapter,
        f""", typed as (
  select cast(VendorID as int) as VendorID,
         cast(trunc(passenger_count) as int) as passenger_count,
         total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
         cast(year(tpep_pickup_datetime) as int) as trip_year,
         cast(month(tpep_pickup_datetime) as int) as trip_month
  from bronze),
valid as (
  select * from typed
  where tpep_dropoff_datetime >= tpep_pickup_datetime
    and total_amount >= 0 and passenger_count > 0
    and trip_year = {period.year}
    and trip_month between {period.first_month} and {period.last_month}),
silver as (select distinct * from valid)
{select}""",
    )


# Text in some years of the longer input, and a number in others.
_CODE = """case y % 5 when 1 then 'c' || cast(fee as varchar)
                    when 2 then cast(fee as varchar) end as code"""


def _landing_sql(adapter: Adapter, select: str = "select * from landed") -> str:
    """``landed`` is what the landing files of an adapter hold, in uniform types."""
    return _with_bronze(
        adapter,
        f""", dated as (
  select *, coalesce(tpep_pickup_datetime, timestamp '{adapters.UNDATED}') as landed_at,
         cast(year(landed_at) as int) as y, cast(month(landed_at) as int) as m
  from ingested),
landed as (
  select cast(VendorID as double) as VendorID, passenger_count,
         case when y % 5 <> 2 then cast(fee as double) end as airport_fee,
         case when y % 5 = 4 then flag end as note,
         {_CODE + ',' if adapter is LINEITEM else ''}
         total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
         'file=' || prefix || '_' || strftime(landed_at, '%Y-%m') || '.parquet'
           as _source_file,
         y as _ref_year, m as _ref_month
  from dated)
{select}""",
    )


def _month_sql() -> str:
    return _with_silver(
        LINEITEM,
        "select trip_year, trip_month, round(avg(total_amount), 2) as avg_total_amount "
        "from silver group by trip_year, trip_month",
    )


def _hour_sql() -> str:
    return _with_silver(
        EVENTS,
        "select cast(hour(tpep_pickup_datetime) as int) as pickup_hour, "
        "round(avg(passenger_count), 2) as avg_passenger_count "
        f"from silver where trip_month = {EVENTS.hour_month} group by 1",
    )


_QUARTILES = {name: share for share, name in profile.QUARTILES.items()}
_AGGREGATES = {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}


def _summary_sql() -> str:
    def value(statistic: str, column: str) -> str:
        if statistic in _QUARTILES:
            number = f"quantile_disc({column}, {_QUARTILES[statistic]})"
        else:
            number = f"{_AGGREGATES[statistic]}({column})"
        return f"round(cast({number} as double), 6) as {column}"

    rows = [
        f"select '{statistic}' as summary, "
        + ", ".join(value(statistic, c) for c in profile.SUMMARY_COLUMNS)
        + " from silver"
        for statistic in profile.STATISTICS
    ]
    return _with_silver(EVENTS, " union all ".join(rows))


_HISTOGRAM = """
, band as (select total_amount as v from silver where total_amount > 0 and total_amount < 200),
bounds as (select min(v) as lo, max(v) as hi from band),
edges as (
  select cast(i as int) as bin, i * ((hi - lo) / 50.0::double) + lo as bin_start,
         case when i = 49 then hi else (i + 1) * ((hi - lo) / 50.0::double) + lo end as bin_end
  from bounds, range(50) as r(i))
select bin, bin_start, bin_end, count(v) as trip_count
from edges left join band
  on v >= bin_start and (v < bin_end or (bin = 49 and v = bin_end))
group by bin, bin_start, bin_end
"""


_TOP_10 = """
select tpep_pickup_datetime, passenger_count, total_amount from silver
order by total_amount desc, tpep_pickup_datetime, passenger_count desc limit 10
"""


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB."""
    all_silver = "select * from silver"
    found = {
        "scan_parquet": _with_bronze(LINEITEM, f"select {_TRIP_LIST} from raw"),
        "read_landing": _landing_sql(LINEITEM),
        "scan_table": _with_silver(LINEITEM, all_silver),
        "preview_10": _landing_sql(
            LINEITEM,
            f"select {', '.join(_PREVIEWED)} from landed "
            f"order by {', '.join(f'{c} nulls first' for c in _PREVIEWED)} limit 10",
        ),
        "missing_months": _landing_sql(
            LINEITEM,
            f"select cast({OPEN_YEAR.year} as int) as _ref_year, cast(i as int) as _ref_month "
            f"from range({OPEN_YEAR.first_month}, {OPEN_YEAR.last_month + 1}) as r(i) "
            f"where i not in (select _ref_month from landed where _ref_year = {OPEN_YEAR.year})",
        ),
        "normalize_numeric": """
select cast(l_orderkey as double) as l_orderkey, cast(l_partkey as double) as l_partkey,
       cast(l_suppkey as double) as l_suppkey, cast(l_linenumber as double) as l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem
""",
        "tag_source": _landing_sql(
            LINEITEM,
            "select _source_file, _ref_year, _ref_month, count(*) as \"count\" "
            "from landed group by all",
        ),
        "ingestion_ts": _with_bronze(EVENTS, "select *, true as stamped from bronze"),
        "union_by_name": f"""
with a as ({LINEITEM.raw_sql()}), b as ({EVENTS.raw_sql()})
select flag as note, {_TRIP_LIST}, cast(null as int) as airport_fee from a
union all
select cast(null as varchar) as note, {_TRIP_LIST}, fee as airport_fee from b
""",
        "select_required": _with_bronze(EVENTS, f"select {_TRIP_LIST} from raw"),
        "cast_types": _with_bronze(
            EVENTS,
            "select cast(VendorID as int) as VendorID, "
            "cast(trunc(total_amount) as int) as passenger_count, total_amount, "
            "tpep_pickup_datetime, tpep_dropoff_datetime from bronze",
        ),
        "partition_cols": _with_bronze(
            LINEITEM,
            "select *, cast(year(tpep_pickup_datetime) as int) as trip_year, "
            "cast(month(tpep_pickup_datetime) as int) as trip_month from bronze",
        ),
        "snake_case": _with_silver(
            EVENTS, "select VendorID as vendor_id, * exclude (VendorID) from silver"
        ),
        "quality_filter": _with_silver(EVENTS, "select * from valid"),
        "dedup": _with_bronze(LINEITEM, "select distinct * from bronze"),
        "silver": _with_silver(EVENTS, all_silver),
        "outlier_band": _with_silver(
            EVENTS,
            "select total_amount from silver where total_amount > 0 and total_amount < 200",
        ),
        "gold_month": _month_sql(),
        "gold_hour": _hour_sql(),
        "gold_month_sql": _month_sql(),
        "gold_hour_sql": _hour_sql(),
        "month_avg_count": _with_silver(
            LINEITEM,
            "select cast(date_trunc('month', tpep_pickup_datetime) as timestamp) as month_start, "
            "round(avg(total_amount), 2) as avg_total_amount, count(*) as num_trips "
            "from silver where total_amount > 0 group by 1",
        ),
        "hour_avg_count": _with_silver(
            EVENTS,
            "select cast(hour(tpep_pickup_datetime) as int) as trip_hour, "
            "round(avg(passenger_count), 2) as avg_passenger_count, count(*) as num_trips "
            "from silver where date_trunc('month', tpep_pickup_datetime) = date '2024-01-01' "
            "and passenger_count > 0 group by 1",
        ),
        "volume_by_month": _with_silver(
            LINEITEM,
            'select trip_year, trip_month, count(*) as "count" from silver group by 1, 2',
        ),
        "bronze_volume": _landing_sql(
            LINEITEM, 'select _ref_year, _ref_month, count(*) as "count" from landed group by 1, 2'
        ),
        "passenger_dist": _with_silver(
            EVENTS, 'select passenger_count, count(*) as "count" from silver group by 1'
        ),
        "day_of_week": _with_silver(
            EVENTS,
            "select cast(dayofweek(tpep_pickup_datetime) + 1 as int) as day_of_week, "
            "count(*) as trip_count, round(avg(total_amount), 6) as avg_amount "
            "from silver group by 1",
        ),
        "summary_stats": _summary_sql(),
        "histogram": _with_silver(EVENTS, _HISTOGRAM),
        "row_count": _with_silver(EVENTS, "select count(*) as row_count from silver"),
        "period_bounds": _with_silver(
            EVENTS,
            "select min(tpep_pickup_datetime) as first_pickup, "
            "max(tpep_pickup_datetime) as last_pickup from silver",
        ),
        "layer_counts": _with_silver(
            LINEITEM,
            "select (select count(*) from bronze) as bronze_rows, "
            "(select count(*) from silver) as silver_rows",
        ),
        "top10_amount": _with_silver(EVENTS, _TOP_10),
        "top10_stats": _with_silver(
            EVENTS,
            "select round(avg(total_amount), 6) as avg_amount, "
            f"round(avg(passenger_count), 6) as avg_passengers from ({_TOP_10})",
        ),
        "serve_month": _month_sql(),
        "serve_hour": _hour_sql(),
        "bronze": _landing_sql(LINEITEM),
        "bronze_roundtrip": _landing_sql(EVENTS),
        "silver_roundtrip": _with_silver(EVENTS, all_silver),
        "gold_roundtrip": _hour_sql(),
        "partition_refresh": _with_silver(
            LINEITEM,
            "select * replace (case when trip_month = 3 then total_amount * 2 "
            "else total_amount end as total_amount) from silver",
        ),
        "refreshed_bronze": _landing_sql(LINEITEM),
        "refreshed_silver": _with_silver(LINEITEM, all_silver),
        "refreshed_month": _month_sql(),
    }
    if corpus:
        found |= corpus.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
