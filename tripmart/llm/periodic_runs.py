"""Periodic runs of words, found through a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends keeping it, of at least ``REPEATS`` periods and ``LEAST`` words.

Dictionary: level k names every factor of 2**k words, equal factors alike; a name of the next
level is a pair of names. Levels end when all factors differ or no period can be as long.

Proposals: in a run of period q, take the smallest power of two m that is q or more. The
factor of m words at any place of the run but the last q + m occurs again q words later, and
not before: two closer occurrences would overlap and give the run a smaller period. So next
occurrences at distances above m/2 and up to m, within twice the length that a run of such a
period must leave, propose every period. Equal distances from neighbouring places, or from
places that distance apart, are one arithmetic progression and one proposal, the first.

Runs: a proposal is extended both ways by the longest factors of the dictionary that agree, in
halving steps. Proposals of a multiple of a period extend to the same stretch; the smallest
period stays.

Rows are whole texts, so the work of a task follows its longest text: n log n for n words.

Defined results: no text, or one without words, has no runs. Documents without an id are
treated alike. Repeated rows give repeated results. Other columns are not read, or kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import WORD, rows_in_arrow

# Fixed values of the contract.
REPEATS = 3
LEAST = 24

Run = tuple[int, int, int]  # start, length, period

_RUNS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("start", pa.list_(pa.int64())),
        ("length", pa.list_(pa.int64())),
        ("period", pa.list_(pa.int64())),
        ("best", pa.int64()),
        ("collapsed", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)
_RUNS_DDL = (
    "doc_id long, n_words long, start array<long>, length array<long>, period array<long>, "
    "best long, collapsed string, collapsed_sha256 string"
)


# -- Runs of one text ---------------------------------------------------------------------


def _named(factors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Names of factors by rank, the next place of the same factor (0: none), and how many
    factors there are."""
    order = np.argsort(factors, kind="stable")
    fresh = np.diff(factors[order], prepend=factors[order[:1]] - 1) != 0
    names = np.empty(len(factors), dtype=np.int64)
    names[order] = np.cumsum(fresh) - 1
    following = np.zeros(len(factors), dtype=np.int64)
    again = ~fresh[1:]
    following[order[:-1][again]] = order[1:][again]
    return names, following, int(fresh.sum())


def basic_factors(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(names, next places) of the factors of 1, 2, 4 ... words, up to the first power of two
    of ``longest`` or more."""
    names, following, distinct = _named(words)
    size = 1
    while True:
        yield names, following
        if size >= longest or distinct == len(names) or len(names) <= size:
            return
        pairs = names[:-size] * np.int64(distinct) + names[size:]
        names, following, distinct = _named(pairs)
        size *= 2


def _proposed(following: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the distance of each progression of occurrences of factors of
    ``size`` words whose distance is a period that this size is for."""
    places = np.arange(len(following))
    distance = following - places
    distance[(distance * 2 <= size) | (distance > size)] = 0
    first = distance > 0
    first[1:] &= distance[1:] != distance[:-1]
    places = places[first]
    gap = distance[places]
    before = places - gap
    inside = (before >= 0) & (distance[np.maximum(before, 0)] == gap)
    return places[~inside], gap[~inside]


def _reach(
    levels: list[np.ndarray], one: np.ndarray, two: np.ndarray, step: int
) -> np.ndarray:
    """How many words from two places on agree, forwards or (``step`` -1) backwards from just
    before them."""
    reach = np.zeros(len(one), dtype=np.int64)
    for level in reversed(range(len(levels))):
        names, size = levels[level], 1 << level
        back = size if step < 0 else 0
        left = np.arange(len(one))
        while len(left):
            a = one[left] + step * reach[left] - back
            b = two[left] + step * reach[left] - back
            inside = (a >= 0) & (b >= 0) & (a < len(names)) & (b < len(names))
            left, a, b = left[inside], a[inside], b[inside]
            left = left[names[a] == names[b]]
            reach[left] += size
    return reach


def runs_of(words: list) -> list[Run]:
    """The runs of a list of words, by start, then period."""
    if len(words) < LEAST:
        return []
    places: dict = {}
    ids = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
    if len(places) == len(words):
        return []
    levels: list[np.ndarray] = []
    starts, gaps = [], []
    for names, following in basic_factors(ids, len(words) // REPEATS):
        place, gap = _proposed(following, 1 << len(levels))
        levels.append(names)
        starts.append(place)
        gaps.append(gap)
    place, gap = np.concatenate(starts), np.concatenate(gaps)
    low = place - _reach(levels, place, place + gap, -1)
    high = place + gap + _reach(levels, place, place + gap, 1)
    length = high - low
    long = length >= np.maximum(LEAST, REPEATS * gap)
    smallest: dict[tuple[int, int], int] = {}
    found = zip(low[long].tolist(), length[long].tolist(), gap[long].tolist(), strict=True)
    for start, size, period in found:
        smallest[start, size] = min(period, smallest.get((start, size), period))
    runs = [(start, size, period) for (start, size), period in smallest.items()]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> int | None:
    """The place of the run with the most periods; ties go to the first."""
    if not runs:
        return None
    return min(range(len(runs)), key=lambda i: (-Fraction(runs[i][1], runs[i][2]), i))


def collapsed_words(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]


# -- Over Spark ---------------------------------------------------------------------------


def periodic_runs(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, its runs (start, length, period), the place of
    the strongest among them (best, from 0), the words left when each run is collapsed to its
    first period, joined by one space (collapsed; NULL unless asked for), collapsed_sha256."""

    def found(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            # Bytes split at ASCII white space alone.
            words = (row["text"] or "").encode("utf-8", "surrogatepass").split()
            runs = runs_of(words)
            left = b" ".join(collapsed_words(words, runs))
            start, length, period = zip(*runs, strict=True) if runs else ((), (), ())
            yield (
                row["doc_id"], len(words), start, length, period, strongest(runs),
                left.decode("utf-8", "surrogatepass") if with_text else None,
                hashlib.sha256(left).hexdigest(),
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(rows_in_arrow(found, _RUNS, 500), _RUNS_DDL)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """The documents of the contract: in a tenth of them, told by a checksum of the id, the
    words from some place on repeat with some period.

    A document without an id, or without words, stays as it is.
    """
    check = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size("words")
    start = (F.col("g") % n).cast("int")
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")

    def source(word: Column, i: Column) -> Column:
        a = F.col("a")
        place = F.when(i < a, i).otherwise(a + (i - a) % F.col("p"))
        return F.get("words", place.cast("int"))

    planted = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", check.alias("h"))
        .withColumn("words", F.when(F.col("h") % 10 == 0, words))
        .withColumn("g", F.floor(F.col("h") / 10))
        .withColumn("a", F.when(n > 0, start))
        .withColumn("p", period)
    )
    text = F.when(F.col("a").isNotNull(), F.array_join(F.transform("words", source), " "))
    return planted.select("doc_id", F.coalesce(text, "text").alias("text"))
