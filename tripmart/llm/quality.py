"""Quality rules with thresholds that follow the corpus.

A document has four measures: characters per word, symbols per word, the share of its lines
that repeat an earlier one, and the share of its words in windows that recur. In place of
fixed cutoffs, each measure is held against fences that its language and source set: the
median and so many tail spreads above it (and, for word length, below it). The tail spread is
the mean excess over the median of the half of all values above it, up to a level: what lies
beyond the level is what the corpus may hold of junk, and sets no fence. Where a value other
than zero is rare, it decides by how rare and how large such values are.

Quantiles and excesses come from mergeable sketches: values are counted in bins whose bounds
grow by a constant factor, which gives any value within ``ACCURACY``. Sketches merge by adding
counts, so they are built in the map tasks, do not depend on the order of rows, and those of a
language and of the whole corpus are sums of those of its sources. The fence of a source is
pooled with that of its language, and this one with that of the corpus, as a geometric mean: n
documents have the weight n, and what is above them has the weight ``POOL``. So a group of any
size gets a fence, one full of junk cannot set its own alone, and one odd source does not undo
the fences of the others. Documents that fail the base rules are
not in the sketches.

Fences are joined to the measures; the join side is one row per language and source, of
whatever number, so the planner chooses how. Texts are read once and never moved.

Defined results: no text has no words and fails the base rules; NULL is a language and a
source like any other; repeated rows get a result each. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import WORDS, rows_in_arrow, stored

# Fixed values of the contract.
SYMBOLS = re.compile(r"[#*$%&|<>]")
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
WINDOW = 3

# Parameters: relative accuracy of the sketches, and the weight of what a group is part of.
ACCURACY = 0.01
POOL = 50

# Parameters by measure: the level up to which values count, the tail spreads to the fence, and
# the least distance to it, which covers one symbol or repeat in the shortest document judged
# and the accuracy of the sketches. Only the length of words has a lower fence.
LEVEL = {"word_length": 0.95, "symbols": 0.95, "dup_lines": 0.995, "repeats": 0.995}
SPREADS = {"word_length": 7, "symbols": 4, "dup_lines": 28, "repeats": 20}
LEAST_DISTANCE = {"word_length": 0.1, "symbols": 0.02, "dup_lines": 0.02, "repeats": 0.06}
TWO_SIDED = ("word_length",)
LEAST_FENCE = 0.1

LARGEST_KEY = 1 << 62

_STATS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang", pa.string()),
        ("source", pa.string()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
    ]
)
_STATS_DDL = (
    "doc_id long, lang string, source string, n_words long, word_chars long, "
    "n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
)


# -- Measures of a text ---------------------------------------------------------------


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first time included."""
    places = len(words) - window + 1
    if places < 2:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    keys = ids[:places]
    for ahead in range(1, window):
        if int(keys.max()) >= LARGEST_KEY // len(known):  # number the runs so far anew
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        keys = keys * len(known) + ids[ahead : ahead + places]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for ahead in range(window):
        covered[at + ahead] = True
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(SYMBOLS.findall(text)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def document_stats(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source and the counts of its text."""

    def counted(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["doc_id"], row["lang"], row["source"], *measures(row["text"])

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    )
    return texts.mapInArrow(rows_in_arrow(counted, _STATS), _STATS_DDL)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )


def _values() -> dict[str, Column]:
    """The measures, zero without words."""
    shares = {
        "word_length": ("word_chars", "n_words"),
        "symbols": ("n_symbols", "n_words"),
        "dup_lines": ("n_dup_lines", "n_lines"),
        "repeats": ("n_repeat_words", "n_words"),
    }
    return {
        name: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
        for name, (part, whole) in shares.items()
    }


# -- Sketches ---------------------------------------------------------------------------

_GROWTH = (1 + ACCURACY) / (1 - ACCURACY)


def sketch_bin(value: Column) -> Column:
    """The bin of a value: NULL holds zero and what is below."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(_GROWTH)).cast("long"))


def bin_value(number: Column) -> Column:
    """The middle of a bin, within the accuracy of each of its values."""
    middle = F.exp(number * math.log(_GROWTH)) * (2 / (_GROWTH + 1))
    return F.coalesce(middle, F.lit(0.0))


def sketches(stats: DataFrame) -> DataFrame:
    """Sketches of the measures per lang and source: lang, source, measure, bin, n."""
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("measure"), sketch_bin(value).alias("bin"))
            for name, value in _values().items()
        )
    )
    return (
        stats.filter(~base_failed())
        .select("lang", "source", F.inline(entries))
        .groupBy("lang", "source", "measure", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches merged over all groups with the same keys."""
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def _of(parameter: dict[str, float]) -> Column:
    """A parameter by the measure of the row."""
    pairs = chain.from_iterable((k, float(v)) for k, v in parameter.items())
    return F.create_map(*map(F.lit, pairs))[F.col("measure")]


def sketch_fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Fences per keys and measure, and the number of values: keys, measure, values, upper,
    lower."""
    group = Window.partitionBy(*keys, "measure")
    running = group.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = (
        sketch.withColumn("upto", F.sum("n").over(running))
        .withColumn("values", F.sum("n").over(group))
        .withColumn("value", bin_value(F.col("bin")))
    )
    reached = F.when(F.col("upto") >= F.ceil(F.col("values") * 0.5), F.col("value"))
    ranked = ranked.withColumn("middle", F.min(reached).over(group))
    total, level = F.col("values").cast("double"), _of(LEVEL)
    before = F.col("upto") - F.col("n")
    # How much of a bin lies within the level, from either end.
    below = F.least(F.col("upto"), level * total) - F.least(before, level * total)
    above = F.greatest(F.col("upto"), (1 - level) * total) - F.greatest(
        before, (1 - level) * total
    )
    half = total * (level - 0.5)
    over = F.sum(below * F.greatest(F.col("value") - F.col("middle"), F.lit(0.0)) / half)
    under = F.sum(above * F.greatest(F.col("middle") - F.col("value"), F.lit(0.0)) / half)
    middle = F.max("middle")
    return (
        ranked.groupBy(*keys, "measure")
        .agg(F.max("values").alias("values"), middle.alias("middle"), over.alias("over"),
             under.alias("under"))
        .select(
            *keys,
            "measure",
            "values",
            (F.col("middle") + _of(LEAST_DISTANCE) + _of(SPREADS) * F.col("over")).alias("upper"),
            F.greatest(
                F.col("middle") - _of(LEAST_DISTANCE) - _of(SPREADS) * F.col("under"),
                F.lit(LEAST_FENCE),
            ).alias("lower"),
        )
    )


def _wide(found: DataFrame, keys: list[str], label: str) -> DataFrame:
    """One row per keys: the fences of all measures as a struct, and the number of values."""
    columns = [
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{name}_{side}")
        for name, side in _SIDES
    ]
    grouped = found.groupBy(*keys).agg(F.max("values").alias("values"), *columns)
    return grouped.select(
        *(F.col(k).alias(f"{label}_{k}") for k in keys),
        F.struct("values", *(f"{name}_{side}" for name, side in _SIDES)).alias(label),
    )


_SIDES = [(name, "upper") for name in LEVEL] + [(name, "lower") for name in TWO_SIDED]


def _pooled(own: str, rest: Column, side: str) -> Column:
    """A fence of a group and that of what it is part of, by weight."""
    n = F.coalesce(F.col(f"{own}.values"), F.lit(0)).cast("double")
    mean = F.exp((n * F.log(F.col(f"{own}.{side}")) + POOL * F.log(rest)) / (n + POOL))
    return F.when(n > 0, mean).otherwise(rest)


def fences(stats: DataFrame) -> DataFrame:
    """One row per lang and source: lang, source, and the bounds of each measure."""
    own = stored(sketches(stats), "quality-sketches")
    by_source, by_lang, by_all = (
        stored(_wide(sketch_fences(sketch, keys), keys, label), "quality-fences")
        for sketch, label, keys in (
            (own, "s", ["lang", "source"]),
            (merged(own, ["lang"]), "l", ["lang"]),
            (merged(own, []), "c", []),
        )
    )
    corpus = by_all.select("c").scalar()  # one row
    groups = (
        stats.select("lang", "source")
        .distinct()
        .join(
            by_source,
            F.col("lang").eqNullSafe(F.col("s_lang"))
            & F.col("source").eqNullSafe(F.col("s_source")),
            "left",
        )
        .join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
        .withColumn("c", corpus)
    )
    pooled = []
    for name, side in _SIDES:
        column = f"{name}_{side}"
        language = _pooled("l", F.col(f"c.{column}"), column)
        pooled.append(_pooled("s", language, column).alias(column))
    return groups.select("lang", "source", F.struct(*pooled).alias("fences"))


def judged(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept."""
    stats = stored(document_stats(documents), "quality-stats")
    bounds = stored(fences(stats), "quality-bounds").select(
        F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), "fences"
    )
    inside = F.lit(True)
    for name, value in _values().items():
        inside &= value <= F.col(f"fences.{name}_upper")
        if name in TWO_SIDED:
            inside &= value >= F.col(f"fences.{name}_lower")
    return (
        stats.join(
            bounds,
            F.col("lang").eqNullSafe(F.col("f_lang"))
            & F.col("source").eqNullSafe(F.col("f_source")),
        )
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    )
