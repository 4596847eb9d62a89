"""Transformations of whole frames that no layer owns."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, ShortType, StructField

from tripmart.functions.columns import named

# The numeric types that monthly files swap for one another.
# Byte and float are not among them.
DRIFTING_NUMERICS = (ShortType, IntegerType, LongType, DecimalType)


def normalize_numerics(
    df: DataFrame, keep: Collection[str] = (), as_text: Collection[str] = ()
) -> DataFrame:
    """Turn drifting numeric columns into double, so that all months agree.

    Values beyond 2**53 lose digits as doubles; name such columns in ``keep``. Columns in
    ``as_text`` become text, as they are written before any other change. Names go without
    regard to case, as everywhere in the files.
    """
    kept, text = {c.lower() for c in keep}, {c.lower() for c in as_text}

    def uniform(field: StructField) -> Column:
        name = field.name.lower()
        if name in text:
            return named(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, DRIFTING_NUMERICS) and name not in kept:
            return named(field.name).cast("double").alias(field.name)
        return named(field.name)

    return df.select(*map(uniform, df.schema.fields))


def stamp_ingestion(df: DataFrame) -> DataFrame:
    """Add ``_ingested_at``: one timestamp for all rows of the run."""
    return df.withColumn("_ingested_at", F.current_timestamp())


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
