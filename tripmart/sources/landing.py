"""Landing files: one parquet file or folder per month, with drifting schemas.

Entries are named ``<prefix>_YYYY-MM.parquet``. Column types differ between months
and columns come and go, which a single scan over the folder refuses to read.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby
from typing import NamedTuple, TypeVar
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tripmart.config import applied
from tripmart.functions.frames import normalize_numerics, union_all

log = logging.getLogger(__name__)

# Fixed format of landing names; the prefix is free.
_MONTH = re.compile(r"(?:^|_)(\d{4})-(0[1-9]|1[0-2])\.parquet$")

T = TypeVar("T")
R = TypeVar("R")


class Entry(NamedTuple):
    """One landing file, or folder of part files. Sorts by month, then name."""

    year: int
    month: int
    name: str
    path: str
    uri: str
    size: int
    modified: int  # microseconds since 1970

    @property
    def period(self) -> tuple[int, int]:
        return self.year, self.month


def _at_once(function: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Apply a function that waits for storage or short jobs, several items at a time."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(function, items))


# A listing reads no content, so its tasks are not cut by the bytes of the files.
_LISTING = {"spark.sql.files.maxPartitionBytes": str(1 << 50)}


def _condition(error: Exception) -> str:
    """The name of what went wrong, if Spark says so. Some errors of a classic session reach
    Python as they are, with the exception that has the name inside."""
    named = error if isinstance(error, PySparkException) else getattr(error, "java_exception", None)
    try:
        return named.getCondition() or ""
    except Exception:  # no error of Spark's
        return ""


def listing(spark: SparkSession, landing_path: str) -> DataFrame:
    """The ``*.parquet`` entries directly below ``landing_path``: uri, size, modified.

    Spark lists the files, on any file system that it reads, and groups those of a folder: one
    row per entry. Names that Spark takes for hidden, such as those of unfinished uploads, and
    folders without a file are passed over. Of the reader of whole files only what it knows
    without opening them is used.
    """
    folder = landing_path.rstrip("/")
    try:
        files = spark.read.format("binaryFile").load(f"{folder}/[^._]*.parquet")
    except PySparkException as error:
        if not _condition(error).startswith("PATH_NOT_FOUND"):
            raise
        raise FileNotFoundError(f"no parquet file in {landing_path}") from error
    # Up to the first name below the folder that ends like an entry's.
    above = sum(part.endswith(".parquet") for part in folder.split("/"))
    entry = rf"^((?:.*?\.parquet/){{{above}}}.*?\.parquet)(?:/|$)"
    return (
        files.select(
            F.regexp_extract("_metadata.file_path", entry, 1).alias("uri"),
            F.col("_metadata.file_size").alias("size"),
            F.unix_micros("_metadata.file_modification_time").alias("modified"),
        )
        .groupBy("uri")
        .agg(F.sum("size").alias("size"), F.max("modified").alias("modified"))
    )


def landing_entries(spark: SparkSession, landing_path: str) -> list[Entry]:
    """The entries of ``listing`` by month: one per month and prefix, on the driver."""
    folder = landing_path.rstrip("/")
    with applied(spark, _LISTING):
        found = listing(spark, folder).collect()
    if not found:
        raise FileNotFoundError(f"no parquet file in {landing_path}")
    entries = []
    for row in found:
        name = unquote(row.uri.rsplit("/", 1)[1])
        month = _MONTH.search(name)
        if month is None:
            raise ValueError(f"landing name does not end in _YYYY-MM.parquet: {name}")
        path = f"{folder}/{name}"
        entries.append(
            Entry(int(month[1]), int(month[2]), name, path, row.uri, row.size, row.modified)
        )
    return sorted(entries)


def merged_schemas(
    spark: SparkSession, entries: Sequence[Entry]
) -> list[tuple[StructType, list[Entry]]]:
    """Runs of entries whose schemas merge, each with the merged schema.

    Executors read the footers. The entries of a year are tried in one job, and halved
    where types differ: jobs grow with the years and the changes, not with the entries.
    """
    years = [list(group) for _, group in groupby(sorted(entries), key=lambda e: e.year)]
    runs = _at_once(lambda year: _merged_run(spark, year), years)
    return [run for year in runs for run in year]


def _merged_run(
    spark: SparkSession, entries: list[Entry]
) -> list[tuple[StructType, list[Entry]]]:
    try:
        scan = spark.read.option("mergeSchema", True).parquet(*(e.path for e in entries))
        return [(scan.schema, entries)]
    except Exception as error:
        if len(entries) == 1 or not _condition(error).startswith("CANNOT_MERGE_SCHEMAS"):
            raise
    half = len(entries) // 2
    return _merged_run(spark, entries[:half]) + _merged_run(spark, entries[half:])


def tag_source(df: DataFrame, entries: Sequence[Entry]) -> DataFrame:
    """Add ``_source_file``, ``_ref_year`` and ``_ref_month`` to a scan of these entries.

    What the entries have in common is a literal; the rest is cut out of the path of
    each row's file, by position.
    """
    first = entries[0]
    # Drops the names of part files, where the entry is a folder.
    uri = F.substring_index(F.col("_metadata.file_path"), "/", first.uri.count("/") + 1)
    name = F.substring_index(uri, "/", -1)
    if len(entries) == 1:
        source = F.lit(first.path)
    else:
        plain = all(re.fullmatch(r"[\w.=-]+", e.name, re.ASCII) for e in entries)
        decoded = name if plain else F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        source = F.concat(F.lit(first.path.removesuffix(first.name)), decoded)
    if len({e.period for e in entries}) == 1:
        year, month = F.lit(first.year), F.lit(first.month)
    else:  # from the end of _YYYY-MM.parquet
        year = F.substring(name, -15, 4).cast("int")
        month = F.substring(name, -10, 2).cast("int")
    return df.select(
        "*",
        source.alias("_source_file"),
        year.alias("_ref_year"),
        month.alias("_ref_month"),
    )


def read_landing(
    spark: SparkSession,
    landing_path: str,
    keep: Collection[str] = (),
    entries: Sequence[Entry] | None = None,
    as_text: Collection[str] = (),
) -> DataFrame:
    """All landing rows with uniform types and their origin.

    Numbers become double, but for the columns in ``keep``. A column that is text in any
    month, or named in ``as_text``, is text in all. Entries with the same schema share a scan, so the plan grows with
    the number of schemas, and neither with the files nor with the calendar.
    """
    entries = landing_entries(spark, landing_path) if entries is None else entries
    scans: dict[str, tuple[StructType, list[Entry]]] = {}
    for schema, run in merged_schemas(spark, entries):
        scans.setdefault(schema.json(), (schema, []))[1].extend(run)
    log.info("%d landing entries in %d scans", len(entries), len(scans))
    fields = [f for schema, _ in scans.values() for f in schema.fields]
    unknown = {c.lower() for c in keep} - {f.name.lower() for f in fields}
    if unknown:
        raise ValueError(f"no landing file has the columns {sorted(unknown)}")
    text = {f.name.lower() for f in fields if isinstance(f.dataType, StringType)}
    text |= {c.lower() for c in as_text}
    other = {f.name.lower() for f in fields if not isinstance(f.dataType, StringType)}

    def scanned(scan: tuple[StructType, list[Entry]]) -> DataFrame:
        schema, files = scan
        rows = spark.read.schema(schema).parquet(*(e.path for e in files))
        return tag_source(normalize_numerics(rows, keep, text & other), files)

    # Spark lists the files of a scan when it is made.
    return union_all(_at_once(scanned, scans.values()))
