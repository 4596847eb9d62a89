"""Landing to bronze to silver to gold."""

from __future__ import annotations

import logging
from calendar import month_abbr
from collections.abc import Callable, Collection, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import (
    BRONZE_PARTITIONS,
    DEFAULT_HOUR_MONTH,
    DEFAULT_PERIOD,
    Lake,
    Period,
    applied,
    session_settings,
)
from tripmart.functions.columns import named, within
from tripmart.functions.frames import stamp_ingestion
from tripmart.operators import marts
from tripmart.operators.refine import refine
from tripmart.sources.landing import Entry, landing_entries, read_landing
from tripmart.sources.tables import (
    ensure_schema,
    overwrite_table,
    read_table,
    replace_partitions,
    write_bronze,
    write_gold,
    write_silver,
)

log = logging.getLogger(__name__)

# The names under which the two marts are stored; the second ends in the
# first letters of its month.
MONTH_MART = "avg_total_amount_by_month"
HOUR_MART = "avg_passenger_count_by_hour"


def hour_mart(month: int = DEFAULT_HOUR_MONTH) -> str:
    """The name of the hour mart of a month."""
    return f"{HOUR_MART}_{month_abbr[month].lower()}"


def default_marts(
    period: Period = DEFAULT_PERIOD, hour_month: int = DEFAULT_HOUR_MONTH
) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The marts by table name. Add entries to build more."""
    return {
        MONTH_MART: marts.amount_by_month,
        hour_mart(hour_month): lambda silver: marts.passengers_by_hour(
            silver, period.year, hour_month
        ),
    }


def _ensure_layer(spark: SparkSession, lake: Lake, schema: str) -> None:
    ensure_schema(spark, lake.schema(schema), lake.schema_location(schema))


def _settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    return session_settings(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))


def build_bronze(
    spark: SparkSession,
    lake: Lake,
    input_bytes: int = 0,
    keep: Collection[str] = (),
    entries: Sequence[Entry] | None = None,
) -> int:
    """Ingest all landing files; returns the number of rows.

    Here and below, ``input_bytes`` is the size of the landing files, by which the work is
    cut into tasks. Without it, the session's own sizes apply. ``entries`` are the landing
    entries, where they have been listed already.
    """
    with applied(spark, _settings(spark, input_bytes)):
        _ensure_layer(spark, lake, lake.bronze_schema)
        rows = stamp_ingestion(read_landing(spark, lake.landing_path, keep, entries))
        return write_bronze(rows, lake.bronze_table, lake.table_format)


def build_silver(
    spark: SparkSession,
    lake: Lake,
    period: Period = DEFAULT_PERIOD,
    reject_nan: bool = False,
    input_bytes: int = 0,
) -> int:
    """Rebuild the trusted table; returns the number of rows."""
    with applied(spark, _settings(spark, input_bytes)):
        _ensure_layer(spark, lake, lake.silver_schema)
        trips = refine(read_table(spark, lake.bronze_table), period, reject_nan)
        return write_silver(trips, lake.silver_table, lake.table_format)


def build_gold(
    spark: SparkSession, lake: Lake, marts_by_name: dict[str, Callable[[DataFrame], DataFrame]]
) -> dict[str, int]:
    """Rebuild the marts; returns the number of rows of each.

    Each mart scans the trusted table for its own few columns and partitions. That
    reads less than caching all of it would. A handful of rows per task crosses their
    shuffles, so the session's own number of partitions does.
    """
    with applied(spark, session_settings()):
        _ensure_layer(spark, lake, lake.gold_schema)
        silver = read_table(spark, lake.silver_table)
        return {
            name: write_gold(mart(silver), lake.gold_table(name), lake.table_format)
            for name, mart in marts_by_name.items()
        }


def run_all(
    spark: SparkSession,
    lake: Lake,
    period: Period = DEFAULT_PERIOD,
    hour_month: int = DEFAULT_HOUR_MONTH,
    keep: Collection[str] = (),
    reject_nan: bool = False,
) -> dict[str, int]:
    """Build every layer, sized by the landing files; returns the number of rows per table."""
    return _rebuild(
        spark, lake, landing_entries(spark, lake.landing_path), period, hour_month, keep, reject_nan
    )


def _rebuild(
    spark: SparkSession,
    lake: Lake,
    entries: Sequence[Entry],
    period: Period,
    hour_month: int,
    keep: Collection[str],
    reject_nan: bool,
) -> dict[str, int]:
    size = sum(entry.size for entry in entries)
    _ensure_layer(spark, lake, lake.bronze_schema)
    # Until this run is complete, a refresh after it must not trust the layers.
    spark.sql(f"DROP TABLE IF EXISTS {lake.ledger_table}")
    rows = {
        lake.bronze_table: build_bronze(spark, lake, size, keep, entries),
        lake.silver_table: build_silver(spark, lake, period, reject_nan, size),
    } | build_gold(spark, lake, default_marts(period, hour_month))
    spark.sql(f"DROP TABLE IF EXISTS {lake.pending_table}")
    _write_ledger(spark, lake, entries, _terms(period, hour_month, keep, reject_nan))
    return rows


# -- Runs that only do what is new -------------------------------------------------------


def _terms(
    period: Period, hour_month: int, keep: Collection[str], reject_nan: bool
) -> str:
    """What the layers depend on besides the landing files."""
    return f"{period}|{hour_month}|{sorted(c.lower() for c in keep)}|{reject_nan}"


_LEDGER = "name string, year int, month int, size long, modified long, terms string"


def _as_frame(spark: SparkSession, entries: Sequence[Entry], terms: str) -> DataFrame:
    rows = [(e.name, e.year, e.month, e.size, e.modified, terms) for e in entries]
    return spark.createDataFrame(rows, _LEDGER)


def _write_ledger(
    spark: SparkSession, lake: Lake, entries: Sequence[Entry], terms: str
) -> None:
    ledger = _as_frame(spark, entries, terms).coalesce(1)
    overwrite_table(ledger, lake.ledger_table, table_format=lake.table_format)


def changed_months(
    spark: SparkSession, lake: Lake, entries: Sequence[Entry], terms: str
) -> list[tuple[int, int]] | None:
    """The file months with entries that are new, changed or gone since the last complete run;
    None if there was none, or one on other terms.

    An entry has changed if its size or the time of its last change has.
    """
    if not spark.catalog.tableExists(lake.ledger_table):
        return None
    ledger = read_table(spark, lake.ledger_table)
    if not ledger.filter(F.col("terms") != terms).isEmpty():
        return None
    now = _as_frame(spark, entries, terms)
    # An entry of the same name with another size is on both sides, and so is its month.
    key = ["name", "size", "modified"]
    changes = now.join(ledger, key, "left_anti").unionByName(ledger.join(now, key, "left_anti"))
    return sorted(tuple(r) for r in changes.select("year", "month").distinct().collect())


def _event_months(rows: DataFrame, period: Period) -> set[int]:
    """The months of the period that the pickups of some rows fall into: twelve at most."""
    pickup = F.col("tpep_pickup_datetime").try_cast("timestamp")
    inside = rows.select(pickup.alias("pickup")).filter(within(F.col("pickup"), period))
    return {r[0] for r in inside.select(F.month("pickup")).distinct().collect()}


def _in_months(bronze: DataFrame, period: Period, months: Collection[int]) -> DataFrame:
    """Rows with a pickup in some months of the period, as far as the scan can tell."""
    if not dict(bronze.dtypes)["tpep_pickup_datetime"].startswith("timestamp"):
        return bronze
    pickup = F.col("tpep_pickup_datetime")
    return bronze.filter(reduce(or_, (within(pickup, period.month(m)) for m in sorted(months))))


def refresh_all(
    spark: SparkSession,
    lake: Lake,
    period: Period = DEFAULT_PERIOD,
    hour_month: int = DEFAULT_HOUR_MONTH,
    keep: Collection[str] = (),
    reject_nan: bool = False,
) -> dict[str, int]:
    """Bring every layer up to date with the landing files; returns the number of rows written
    per table, and nothing for a table that stayed as it was.

    Entries are compared with the ledger of the last complete run. Bronze gets the file months
    with a difference anew, silver the event months that rows of those months fall into, before
    or after, and the marts are computed again where silver has changed. The tables then hold
    what ``run_all`` would write. It runs instead where there is no ledger, or one on other
    terms, and where a new file needs a column that bronze has not, or not as text. Columns stay in
    bronze, and text stays text, when the files that brought them are gone.

    A run that fails is completed by the next one: the ledger is written last, and event months
    to be changed are on record before the bronze rows that tell them are replaced.
    """
    entries = landing_entries(spark, lake.landing_path)
    terms = _terms(period, hour_month, keep, reject_nan)
    months = changed_months(spark, lake, entries, terms)

    def rebuild() -> dict[str, int]:
        return _rebuild(spark, lake, entries, period, hour_month, keep, reject_nan)

    if months is None:
        return rebuild()
    pending = set()
    if spark.catalog.tableExists(lake.pending_table):
        pending = {r.month for r in read_table(spark, lake.pending_table).collect()}
    if not months and not pending:
        log.info("nothing new in %s", lake.landing_path)
        return {}
    written: dict[str, int] = {}
    touched = [e for e in entries if e.period in set(months)]
    with applied(spark, _settings(spark, sum(e.size for e in touched))):
        bronze = read_table(spark, lake.bronze_table)
        if months:
            fresh = _fresh_rows(spark, lake, touched, keep, bronze)
            if fresh is None:
                return rebuild()
            year, month = map(F.col, BRONZE_PARTITIONS)
            stale = reduce(or_, ((year == y) & (month == m) for y, m in months))
            pending |= _event_months(bronze.filter(stale), period)
            _write_pending(spark, lake, pending)
            written[lake.bronze_table] = replace_partitions(fresh, lake.bronze_table, months)
            bronze = read_table(spark, lake.bronze_table)
            pending |= _event_months(bronze.filter(stale), period)
            _write_pending(spark, lake, pending)
        if pending:
            trips = refine(_in_months(bronze, period, pending), period, reject_nan)
            trips = trips.filter(F.col("trip_month").isin(sorted(pending)))
            of_year = [(period.year, m) for m in sorted(pending)]
            written[lake.silver_table] = replace_partitions(trips, lake.silver_table, of_year)
    if pending:
        written |= build_gold(spark, lake, default_marts(period, hour_month))
    _write_ledger(spark, lake, entries, terms)
    spark.sql(f"DROP TABLE IF EXISTS {lake.pending_table}")
    return written


def _fresh_rows(
    spark: SparkSession,
    lake: Lake,
    entries: Sequence[Entry],
    keep: Collection[str],
    bronze: DataFrame,
) -> DataFrame | None:
    """The rows of some entries in the columns of bronze; None if they do not fit there."""
    if not entries:  # all of their months are gone
        return bronze.limit(0)
    types = {f.name.lower(): f.dataType for f in bronze.schema}
    text = {name for name, kind in types.items() if kind.typeName() == "string"}
    try:
        rows = stamp_ingestion(read_landing(spark, lake.landing_path, keep, entries, text))
    except ValueError:  # a column to keep is in other months only
        return None
    if any(types.get(f.name.lower()) != f.dataType for f in rows.schema):
        return None
    found = {c.lower() for c in rows.columns}
    missing = [f for f in bronze.schema if f.name.lower() not in found]
    return rows.select(
        "*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing)
    ).select(*(named(f.name) for f in bronze.schema))


def _write_pending(spark: SparkSession, lake: Lake, months: Collection[int]) -> None:
    rows = spark.createDataFrame([(m,) for m in sorted(months)], "month int")
    overwrite_table(rows.coalesce(1), lake.pending_table, table_format=lake.table_format)
