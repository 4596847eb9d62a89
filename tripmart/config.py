"""Names, columns, periods and session settings of the trip tables."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# The columns the trusted table keeps, in order, with their types.
TRIP_COLUMNS = {
    "VendorID": "int",
    "passenger_count": "int",
    "total_amount": "double",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
}

# The column whose published name is not snake case.
SNAKE_CASE = {"VendorID": "vendor_id"}

# How the tables are laid out on disk.
BRONZE_PARTITIONS = ("_ref_year", "_ref_month")
SILVER_PARTITIONS = ("trip_year", "trip_month")


@dataclass(frozen=True)
class Period:
    """A run of whole months within one year."""

    year: int = 2023
    first_month: int = 1
    last_month: int = 5

    def __post_init__(self) -> None:
        if not 1 <= self.first_month <= self.last_month <= 12:
            raise ValueError(f"not a run of months: {self.first_month}..{self.last_month}")

    @property
    def months(self) -> int:
        return self.last_month - self.first_month + 1

    def month(self, number: int) -> Period:
        """One month of the same year."""
        return Period(self.year, number, number)

    @property
    def start(self) -> str:
        """First instant inside the period."""
        return f"{self.year:04d}-{self.first_month:02d}-01 00:00:00"

    @property
    def end(self) -> str:
        """First instant after the period."""
        year, month = divmod(self.year * 12 + self.last_month, 12)
        return f"{year:04d}-{month + 1:02d}-01 00:00:00"


DEFAULT_PERIOD = Period()
DEFAULT_HOUR_MONTH = 5


@dataclass(frozen=True)
class Lake:
    """Where the layers live: one schema per layer, in an optional catalog.

    ``location`` puts each new schema into a folder of its own below it; without it
    the catalog's warehouse folder is used.
    """

    landing_path: str
    catalog: str | None = None
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    trips: str = "yellow_taxi_trips"
    location: str | None = None
    table_format: str = "parquet"

    def schema(self, name: str) -> str:
        return f"{self.catalog}.{name}" if self.catalog else name

    def schema_location(self, name: str) -> str | None:
        return f"{self.location.rstrip('/')}/{name}" if self.location else None

    @property
    def bronze_table(self) -> str:
        return f"{self.schema(self.bronze_schema)}.{self.trips}"

    @property
    def silver_table(self) -> str:
        return f"{self.schema(self.silver_schema)}.{self.trips}"

    @property
    def ledger_table(self) -> str:
        """What has been ingested: one row per landing entry."""
        return f"{self.bronze_table}_ledger"

    @property
    def pending_table(self) -> str:
        """Event months that a run has begun to change."""
        return f"{self.bronze_table}_pending"

    def gold_table(self, mart: str) -> str:
        return f"{self.schema(self.gold_schema)}.{mart}"


_MB = 1024 * 1024
MOST_REDUCE_PARTITIONS = 20_000


def task_bytes(input_bytes: int) -> int:
    """Input per scan task: some 20 thousand tasks, of 64 MB to 1 GB each."""
    return min(1024 * _MB, max(64 * _MB, input_bytes // 20_000))


def session_settings(input_bytes: int = 0, least_partitions: int = 1) -> dict[str, str]:
    """Session settings for pipeline runs.

    Scans and shuffles are cut into tasks by ``input_bytes``, where it is given. A shuffle
    has as many blocks as map tasks times reduce partitions, and fewer bytes cross it than
    are read: so the number of reduce partitions is bounded, and adaptive execution splits
    and merges what is written after it by its own size.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.caseSensitive": "false",
        "spark.sql.adaptive.enabled": "true",
        # Merge small partitions up to the size below, also where cores would be idle:
        # the files that are written should be large.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # One open file per month and task, instead of sorting each task by month.
        "spark.sql.maxConcurrentOutputFileWriters": "24",
    }
    if input_bytes:
        each = task_bytes(input_bytes)
        partitions = max(least_partitions, math.ceil(input_bytes / each))
        settings |= {
            "spark.sql.files.maxPartitionBytes": str(max(128 * _MB, each)),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(
                min(partitions, max(least_partitions, MOST_REDUCE_PARTITIONS))
            ),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(256 * _MB, each)),
        }
    return settings


@contextmanager
def applied(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session settings for a block and put the earlier ones back after it."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
