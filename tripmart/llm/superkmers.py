"""Substring dedup by super-k-mers: long passages that repeat across documents.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash among its grams
of ``GRAM`` words. Neighbouring windows mostly share it; such a run of windows is a
super-k-mer, one string of words that travels as a whole. Equal windows have equal
minimisers, so all copies of a window meet in the bucket of its minimiser, where sorting the
windows tells exactly which are equal and the smallest document of each.

1. One pass over the texts lists the super-k-mers: where they begin, how many windows they
   have, their minimiser and a 128-bit name of their string.
2. Minimisers that only one document has are done with: nothing repeats there. Where all
   strings of a minimiser are the same, all its windows have the same smallest document.
   Strings themselves travel only for what is left, and each string once, however many
   documents hold it.
3. Buckets sort the windows of their strings. A bucket of more than ``LARGE`` strings, as
   the edges of a passage that very many documents share make it, is dealt out by the words
   of its windows instead: equal windows meet, first within the map tasks. Both ways compare
   the words themselves.
4. Windows with a smaller document give spans of words to remove, per document.

Defined results: no text has no words. A document without an id is never smaller and
nothing is taken from it. Rows repeated with the same id are the same document: they take
nothing from each other. Other columns are not read, or kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import rows_in_arrow, stored

# Fixed value of the contract: words of a window.
WINDOW = 50

GRAM = 6
# Strings of a bucket that are sorted in one task; it splits work, and decides no result.
LARGE = 1000
# Windows of one string at most; a longer run, as of one word repeated, is several strings.
LONGEST = 256

_SUPERS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text1", pa.int64()),
        ("text2", pa.int64()),
        ("start", pa.list_(pa.int32())),
        ("windows", pa.list_(pa.int32())),
        ("minimiser", pa.list_(pa.int64())),
        ("name1", pa.list_(pa.int64())),
        ("name2", pa.list_(pa.int64())),
    ]
)
_SUPERS_DDL = (
    "doc_id long, text1 long, text2 long, start array<int>, windows array<int>, "
    "minimiser array<long>, name1 array<long>, name2 array<long>"
)
_PACKED = pa.schema(
    [
        ("minimiser", pa.int64()),
        ("name1", pa.int64()),
        ("name2", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("packed", pa.binary()),
        ("window", pa.int32()),
    ]
)
_PACKED_DDL = (
    "minimiser long, name1 long, name2 long, low long, high long, packed binary, window int"
)
_SPANS = pa.schema(
    [
        ("name1", pa.int64()),
        ("name2", pa.int64()),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("low", pa.int64()),
    ]
)
_SPANS_DDL = "name1 long, name2 long, first int, last int, low long"
_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.string()),
        ("kept_sha256", pa.string()),
    ]
)


# -- Super-k-mers of a text ---------------------------------------------------------------


def split_words(text: str | None) -> list[bytes]:
    """Words as UTF-8; bytes split at ASCII white space alone."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _bounds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends in the words joined by one space."""
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    return np.concatenate(([0], ends[:-1] + 1)), ends


def window_minimisers(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The smallest gram hash of every window."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - gram + 1
    mixed = hashes[:n]
    for ahead in range(1, gram):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[ahead : ahead + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    reach, width = 1, window - gram + 1
    while reach < width:  # the smallest of a run, by doubling
        step = min(reach, width - reach)
        mixed = np.minimum(mixed[:-step], mixed[step:])
        reach += step
    return mixed


def super_kmers(
    words: list[bytes], window: int = WINDOW, gram: int = GRAM
) -> list[tuple[int, int, int]]:
    """(start, windows, minimiser) of each run of windows with one minimiser."""
    if len(words) < window:
        return []
    minimisers = window_minimisers(words, window, gram)
    starts = np.flatnonzero(np.diff(minimisers, prepend=~minimisers[:1])).tolist()
    found = []
    for start, end in zip(starts, [*starts[1:], len(minimisers)], strict=True):
        minimiser = int(minimisers[start].view(np.int64))
        for at in range(start, end, LONGEST):
            found.append((at, min(LONGEST, end - at), minimiser))
    return found


def _names(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names, as two signed numbers."""
    digests = b"".join(map(xxhash.xxh3_128_digest, contents))
    both = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _text_names() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("text1"), F.xxhash64(F.lit(1), text).alias("text2")]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_names(), "text")


def listed(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The super-k-mers of all documents with an id: doc_id, text1, text2, start, windows,
    minimiser, name1, name2."""

    def supers(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = split_words(row["text"])
            found = super_kmers(words, window)
            if not found:
                continue
            joined, (begin, end) = b" ".join(words), _bounds(words)
            start, windows, minimiser = (np.array(c) for c in zip(*found, strict=True))
            low, high = begin[start].tolist(), end[start + windows + window - 2].tolist()
            one, two = _names([joined[a:b] for a, b in zip(low, high, strict=True)])
            yield row["doc_id"], row["text1"], row["text2"], start, windows, minimiser, one, two

    # A few hundred entries a row: batches of fewer rows.
    rows = _texts(documents).filter("doc_id is not null")
    found = stored(rows.mapInArrow(rows_in_arrow(supers, _SUPERS, 200), _SUPERS_DDL), "supers")
    entries = F.arrays_zip("start", "windows", "minimiser", "name1", "name2")
    return found.select("doc_id", "text1", "text2", F.inline(entries))


# -- Smallest documents of windows ----------------------------------------------------------


def packed_strings(strings: DataFrame, documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The words of strings, cut out of one document that holds them.

    ``strings`` has minimiser, name1, name2, low, high, large, and ``held``: a struct of
    doc_id, text1, text2, start, windows. Of a string of a large bucket each window is a row
    of its own, with its place in the string as ``window``.
    """
    held = strings.groupBy("held.doc_id", "held.text1", "held.text2").agg(
        F.collect_list(
            F.struct(
                "minimiser", "name1", "name2", "low", "high", "large", "held.start", "held.windows"
            )
        ).alias("strings")
    )

    def pack(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = split_words(row["text"])
            joined, (begin, end) = b" ".join(words), _bounds(words)
            for s in row["strings"]:
                start, windows = s["start"], s["windows"]
                who = (s["minimiser"], s["name1"], s["name2"], s["low"], s["high"])
                if s["large"]:
                    for i in range(start, start + windows):
                        yield *who, joined[begin[i] : end[i + window - 1]], i - start
                else:
                    yield *who, joined[begin[start] : end[start + windows + window - 2]], None

    keys = ["doc_id", "text1", "text2"]
    texts = _texts(documents).join(stored(held, "supers-held"), keys)
    # Repeated rows would give the same strings again.
    return texts.mapInArrow(rows_in_arrow(pack, _PACKED, 500), _PACKED_DDL)


def _window_bytes(packed: bytes, window: int) -> list[bytes]:
    begin, end = _bounds(packed.split())
    lows, highs = begin[: len(begin) - window + 1].tolist(), end[window - 1 :].tolist()
    return [packed[a:b] for a, b in zip(lows, highs, strict=True)]


def bucket_spans(strings: list[tuple], window: int = WINDOW) -> Iterator[tuple]:
    """Sort the windows of a bucket; give (string, first, last, low) for the runs of windows
    whose smallest document ``low`` comes before the last document of the string.

    ``strings`` has (low, high, packed) of each string.
    """
    windows = [
        (content, place, at)
        for place, (_, _, packed) in enumerate(strings)
        for at, content in enumerate(_window_bytes(packed, window))
    ]
    windows.sort()
    lows: list[dict[int, int]] = [{} for _ in strings]
    start = 0
    for i in range(1, len(windows) + 1):
        if i == len(windows) or windows[i][0] != windows[start][0]:
            same = windows[start:i]
            low = min(strings[place][0] for _, place, _ in same)
            for _, place, at in same:
                if low < strings[place][1]:
                    lows[place][at] = low
            start = i
    for place, found in enumerate(lows):
        first = None
        for at in sorted(found):
            if first is not None and found.get(at - 1) == found[at]:
                continue
            if first is not None:
                yield place, first, last_of(found, first), found[first]
            first = at
        if first is not None:
            yield place, first, last_of(found, first), found[first]


def last_of(found: dict[int, int], first: int) -> int:
    """The end of the run of windows with the same value that begins at ``first``."""
    last = first
    while found.get(last + 1) == found[first]:
        last += 1
    return last


def _sorted_buckets(packed: DataFrame, window: int) -> DataFrame:
    """Spans from the buckets of whole strings."""

    def spans(rows: Iterator[dict]) -> Iterator[tuple]:
        bucket: list[tuple] = []
        names: dict[tuple[int, int], None] = {}
        key = None

        def done() -> Iterator[tuple]:
            who = list(names)
            for place, first, last, low in bucket_spans(bucket, window):
                yield *who[place], first, last, low

        for row in rows:
            if row["minimiser"] != key:
                yield from done()
                key, bucket, names = row["minimiser"], [], {}
            name = (row["name1"], row["name2"])
            if name not in names:
                names[name] = None
                bucket.append((row["low"], row["high"], row["packed"]))
        yield from done()

    return (
        packed.filter("window is null")
        .drop("window")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(rows_in_arrow(spans, _SPANS), _SPANS_DDL)
    )


def _dealt_windows(packed: DataFrame) -> DataFrame:
    """Spans of one window each, from strings of large buckets."""
    rows = packed.filter("window is not null")
    lowest = (
        rows.groupBy("packed")
        .agg(F.min("low").alias("lowest"), F.max("high").alias("highest"))
        .filter("lowest < highest")
        .drop("highest")
    )
    return (
        rows.join(stored(lowest, "supers-windows"), "packed")
        .filter("lowest < high")
        .selectExpr("name1", "name2", "window as first", "window as last", "lowest as low")
        .distinct()
    )


def repeated_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans of words to remove: doc_id, text1, text2, spans (an array of first, end)."""
    entries = listed(documents, window)
    shared = (
        entries.groupBy("minimiser")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("minimiser")
    )
    shared = stored(shared, "supers-shared")
    entries = stored(entries.join(shared, "minimiser", "left_semi"), "supers-left")
    strings = stored(
        entries.groupBy("minimiser", "name1", "name2").agg(
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
            F.min(F.struct("doc_id", "text1", "text2", "start", "windows")).alias("held"),
        ),
        "supers-strings",
    )
    buckets = stored(
        strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("strings")), "supers-buckets"
    )
    counted = stored(strings.join(buckets, "minimiser"), "supers-counted")
    alone = counted.filter("strings = 1 and low < high").select(
        "name1", "name2", F.lit(0).alias("first"),
        (F.col("held.windows") - 1).alias("last"), "low",
    )
    several = counted.filter("strings > 1").withColumn("large", F.col("strings") > LARGE)
    packed = stored(packed_strings(several, documents, window), "supers-packed")
    spans = stored(
        alone.unionByName(_sorted_buckets(packed, window)).unionByName(_dealt_windows(packed)),
        "supers-spans",
    )
    found = (
        entries.join(spans, ["name1", "name2"])
        .filter("low < doc_id")
        .select(
            "doc_id", "text1", "text2",
            F.struct(
                (F.col("start") + F.col("first")).alias("first"),
                (F.col("start") + F.col("last") + window).alias("end"),
            ).alias("span"),
        )
    )
    return found.groupBy("doc_id", "text1", "text2").agg(F.collect_set("span").alias("spans"))


# -- Removal ------------------------------------------------------------------------------


def kept_words(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    """The words outside all spans."""
    if not spans:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, [s["first"] for s in spans], 1)
    np.add.at(depth, [s["end"] for s in spans], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]


def without_repeats(
    documents: DataFrame, window: int = WINDOW, with_text: bool = True
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one
    space; NULL unless asked for), kept_sha256."""
    spans = stored(repeated_spans(documents, window), "supers-removed")

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = split_words(row["text"])
            left = kept_words(words, row["spans"])
            joined = b" ".join(left)
            text = joined.decode("utf-8", "surrogatepass") if with_text else None
            digest = hashlib.sha256(joined).hexdigest()
            yield row["doc_id"], len(words), len(words) - len(left), text, digest

    keys = ["doc_id", "text1", "text2"]
    return (
        _texts(documents)
        .join(spans, keys, "left")
        .mapInArrow(
            rows_in_arrow(cut, _KEPT, 500),
            "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string",
        )
    )
