"""Catalog tables: read, overwrite as a whole, refresh single partitions."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.config import BRONZE_PARTITIONS, SILVER_PARTITIONS, applied
from tripmart.functions.columns import named

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table by its qualified name."""
    return spark.table(name)


def preview(df: DataFrame, rows: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """``rows`` rows for a look at the data: any, or the first in an order."""
    return (df.orderBy(*map(named, order_by)) if order_by else df).limit(rows)


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create a schema unless it exists; new managed tables go below ``location``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def overwrite_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
) -> int:
    """Replace a table, schema included, and return the number of rows written.

    The rows are counted by the write itself, in its last stage, where a retried task
    counts once.
    """
    written = Observation(f"write {name}")
    writer = (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format(table_format)
        .mode("overwrite")
        .partitionBy(*partition_by)
    )
    if table_format == "delta":
        # Static overwrite, because replacing the schema and replacing single
        # partitions exclude each other there.
        writer = writer.option("overwriteSchema", "true").option(
            "partitionOverwriteMode", "static"
        )
    writer.saveAsTable(name)
    rows = written.get["rows"]
    log.info("%s: %d rows", name, rows)
    return rows


def write_bronze(df: DataFrame, name: str, table_format: str = "parquet") -> int:
    """Write landing rows by file month.

    A scan task reads one month, or a few small ones, so the files come out large
    without a shuffle.
    """
    return overwrite_table(df, name, BRONZE_PARTITIONS, table_format)


def write_silver(df: DataFrame, name: str, table_format: str = "parquet") -> int:
    """Write trusted rows by event month.

    Removing duplicates spreads every month over all tasks. The rebalance brings each month
    together into few files, and splits a month that is too large for one.
    """
    return overwrite_table(
        df.hint("rebalance", *SILVER_PARTITIONS), name, SILVER_PARTITIONS, table_format
    )


def write_gold(df: DataFrame, name: str, table_format: str = "parquet") -> int:
    """Write a mart: one file as long as it is small."""
    return overwrite_table(df.hint("rebalance"), name, (), table_format)


def replace_partitions(
    df: DataFrame, name: str, partitions: Sequence[tuple[int, int]]
) -> int:
    """Replace the given year and month partitions of a table; returns the rows written.

    ``df`` has rows of these partitions only. One that it has no row for is dropped.
    """
    spark = df.sparkSession
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    written = Observation(f"replace in {name}")
    counts = [
        F.count(F.when((named(keys[0]) == year) & (named(keys[1]) == month), 1)).alias(f"n{i}")
        for i, (year, month) in enumerate(partitions)
    ]
    refresh_partitions(df.observe(written, F.count(F.lit(1)).alias("rows"), *counts), name)
    found = written.get
    for i, (year, month) in enumerate(partitions):
        if not found[f"n{i}"]:
            spark.sql(
                f"ALTER TABLE {name} DROP IF EXISTS PARTITION "
                f"({keys[0]} = {year}, {keys[1]} = {month})"
            )
    log.info("%s: %d rows in %d partitions", name, found["rows"], len(partitions))
    return found["rows"]


def refresh_partitions(df: DataFrame, name: str) -> None:
    """Replace only those partitions of a table that ``df`` has rows for.

    ``df`` may read the table itself: old files go when all new ones are complete.
    """
    spark = df.sparkSession
    table = spark.table(name)
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    with applied(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        (
            df.select(*table.columns)  # insertInto goes by position
            .hint("rebalance", *keys)
            .write.mode("overwrite")
            .insertInto(name)
        )
