"""MinHash near-duplicates by min-max hashing, confirmed on full sets.

A document's set holds the distinct shingles of ``SHINGLE`` words of its text, with A-Z in
lower case; a shorter text is one shingle as a whole. Documents link where the sets have
``LEAST`` percent of their union in common.

Signature: each of ``PERMUTATIONS`` permutations of the hashed shingles is evaluated once and
gives two values, the smallest and the largest. Either agrees between two sets with a
probability equal to their similarity, so a signature of a given length takes half the
evaluations, and as the two are never the same shingle, its estimate varies less. Values of
``ROWS`` permutations make two bands, one of the minima and one of the maxima. Sets at the
least similarity share none of ``BANDS`` bands with a probability of some five in a million.

Buckets: equal sets are one class from the start. Classes that share a band are a bucket.

1. Each class is compared with one of each of its buckets, the lead, which is as many pairs as
   there are entries. The lead is the class with the most company in its own buckets, as the
   original of a family of near copies has. Pairs are confirmed on the full sets, and
   components found.
2. A bucket whose classes are in one component by now is done with, as most families are. In
   others there are strays: classes outside the component that most of the bucket is in. The
   strays beside a component are compared with all that shares a bucket with them and has
   most of it there: in blocks of ``BLOCK`` classes by ``BLOCK``, as products of the matrices
   of their shingles. A block sends no pairs on, but one link per stray and component that it
   finds. So no link depends on the lead, and no task sees more than two blocks.

Defined results: a text without words, or none, has an empty set and links with nothing.
Documents without an id are linked like any other; a component in which none has an id has
no component id. A document is kept if it has its component's id, or neither has one. Repeated
rows, and rows of one id with different texts, are documents of their own. Other columns are
not read, or kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import applied
from tripmart.llm.common import as_batch, rows_in_arrow, stored
from tripmart.llm.components import connected_components
from tripmart.llm.simhash import shingle_hashes

# Fixed values of the contract.
SHINGLE = 2
LEAST = 80

ROWS = 6
BANDS = 40
PERMUTATIONS = ROWS * BANDS // 2
BLOCK = 512

_SEED = 2718
_AT_ONCE = 2048  # shingles whose permuted values are held at once
_COLUMNS = 8192  # shingles of a block that are held as a matrix at once

_PRINTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_name", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set1", pa.int64()),
        ("set2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)
_PRINTS_DDL = (
    "doc_id long, text_name long, n_shingles long, set1 long, set2 long, bands array<long>"
)
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SETS = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


# -- Signatures ---------------------------------------------------------------------------


def shingle_set(text: str | None) -> np.ndarray:
    """The hashes of the distinct shingles, sorted."""
    return np.unique(shingle_hashes(text, SHINGLE))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    draws = rng.integers(0, 1 << 64, size=(2, PERMUTATIONS), dtype=np.uint64)
    return draws[0][:, None], (draws[1] | np.uint64(1))[:, None]


_FLIPS, _FACTORS = _permutations()


def min_max(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest value of a non-empty set under each permutation."""
    low = np.full(PERMUTATIONS, ~np.uint64(0))
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), _AT_ONCE):
        values = shingles[at : at + _AT_ONCE][None, :] ^ _FLIPS
        values *= _FACTORS
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(shingles: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The keys of a set's bands of ``rows`` values each, as signed numbers; none for an empty
    set."""
    if not len(shingles):
        return np.zeros(0, dtype=np.int64)
    values = np.concatenate(min_max(shingles)).reshape(-1, rows)
    keys = np.arange(1, len(values) + 1, dtype=np.uint64)
    for row in range(rows):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + values[:, row]
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


_FILTER_FIRST = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


def _text_name() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_name().alias("text_name"), "text"
    )


def signatures(documents: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, text_name, n_shingles, a 128-bit name of the set (set1,
    set2), bands."""

    def prints(texts: Iterator[dict]) -> Iterator[tuple]:
        for row in texts:
            shingles = shingle_set(row["text"])
            name = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype="<i8")
            one, two = name.tolist()
            bands = band_keys(shingles, rows)
            yield row["doc_id"], row["text_name"], len(shingles), one, two, bands

    return _texts(documents).mapInArrow(rows_in_arrow(prints, _PRINTS), _PRINTS_DDL)


# -- Buckets ------------------------------------------------------------------------------


def _shared(entries: DataFrame) -> DataFrame:
    """Entries (bucket, node) of buckets that several classes are in, with their number
    (``size``) and the class with most company in all of its buckets (``lead``)."""
    buckets = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    buckets = stored(buckets.filter("size > 1"), "minmax-buckets")
    members = stored(entries.join(buckets, "bucket"), "minmax-members")
    company = stored(members.groupBy("node").agg(F.sum("size").alias("company")), "minmax-company")
    leads = (
        members.join(company, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("company", "node")).alias("first"))
        .select("bucket", F.col("first.node").alias("lead"))
    )
    return members.join(stored(leads, "minmax-leads"), "bucket")


def _leads(members: DataFrame) -> DataFrame:
    """Each class with the lead of each of its buckets: a, b."""
    pairs = members.filter("node <> lead").select(
        F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")
    )
    return pairs.distinct()


def _mixed(members: DataFrame, reached: DataFrame) -> DataFrame:
    """The members of buckets in which not all is in one component, stored: bucket, node,
    their component (``label``) and that which most of the bucket is in (``most``)."""
    reached = reached.select(F.col("node").alias("reached"), F.col("component").alias("label"))
    members = stored(
        members.filter("size > 2")
        .join(reached, F.col("node") == F.col("reached"), "left")
        .select("bucket", "node", "size", F.coalesce("label", "node").alias("label")),
        "minmax-labelled",
    )
    counted = members.groupBy("bucket", "size", "label").agg(F.count(F.lit(1)).alias("in_label"))
    mixed = (
        counted.groupBy("bucket", "size")
        .agg(F.max(F.struct("in_label", "label")).alias("largest"))
        .filter("largest.in_label < size")
        .select("bucket", F.col("largest.label").alias("most"))
    )
    joined = members.drop("size").join(stored(mixed, "minmax-mixed"), "bucket")
    return stored(joined, "minmax-mixed")


# -- Blocks of strays ---------------------------------------------------------------------


def shared_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one list shares with each of another."""
    found = np.zeros((len(one), len(two)), dtype=np.float32)
    rows_one = np.repeat(np.arange(len(one)), [len(s) for s in one])
    rows_two = np.repeat(np.arange(len(two)), [len(s) for s in two])
    all_one, all_two = np.concatenate(one), np.concatenate(two)
    known = np.intersect1d(all_one, all_two)
    place_one, place_two = np.searchsorted(known, all_one), np.searchsorted(known, all_two)
    in_one = known[np.minimum(place_one, len(known) - 1)] == all_one if len(known) else None
    in_two = known[np.minimum(place_two, len(known) - 1)] == all_two if len(known) else None
    for at in range(0, len(known), _COLUMNS):
        width = min(_COLUMNS, len(known) - at)
        matrices = []
        for rows, places, inside, size in (
            (rows_one, place_one, in_one, len(one)),
            (rows_two, place_two, in_two, len(two)),
        ):
            here = inside & (places >= at) & (places < at + width)
            matrix = np.zeros((size, width), dtype=np.float32)
            matrix[rows[here], places[here] - at] = 1
            matrices.append(matrix)
        found += matrices[0] @ matrices[1].T
    return found.astype(np.int64)


def block_links(
    strays: list[tuple[int, int, np.ndarray]], others: list[tuple[int, int, np.ndarray]]
) -> Iterator[tuple[int, int]]:
    """Links of strays with classes of other components, one of each component; both lists
    have (node, label, set)."""
    both = shared_counts([s for *_, s in strays], [s for *_, s in others])
    sizes = np.array([len(s) for *_, s in others])
    labels = np.array([label for _, label, _ in others])
    for (node, label, own), shared in zip(strays, both, strict=True):
        close = 100 * shared >= LEAST * (len(own) + sizes - shared)
        places = np.flatnonzero(close & (labels != label))
        for place in places[np.unique(labels[places], return_index=True)[1]].tolist():
            yield node, others[place][0]


def _blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The strays beside each component (``most``) in blocks, with all that they are compared
    with in blocks: most, i, j, stray, node, label, shingles. Each pair of blocks has its
    number."""
    nodes = rows.groupBy("most", "node", "label").agg(F.lit(1).alias("one")).drop("one")
    stray = F.col("label") != F.col("most")
    counted = nodes.groupBy("most").agg(
        F.ceil(F.count(F.when(stray, 1)) / BLOCK).alias("across"),
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("down"),
    )
    counted = stored(counted, "minmax-blocks")
    placed = nodes.join(counted, "most").join(sets, "node")
    number = F.xxhash64("node")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    columns = ["most", "i", "j", "stray", "node", "label", "shingles"]
    as_stray = (
        placed.filter(stray)
        .withColumn("stray", F.lit(True))
        .withColumn("i", F.pmod(number, "across"))
        .withColumn("j", each("down"))
    )
    as_other = (
        placed.withColumn("stray", F.lit(False))
        .withColumn("j", F.pmod(number, "down"))
        .withColumn("i", each("across"))
    )
    return as_stray.select(*columns).unionAll(as_other.select(*columns))


def _stray_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The links of strays, stored: a, b."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, links = None, ([], []), []

        def done() -> None:
            strays, others = sides[True], sides[False]
            if strays and others:
                links.extend((min(p), max(p)) for p in block_links(strays, others))

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True))
            lists = batch.column(6)
            values = lists.values.to_numpy()
            offsets = lists.offsets.to_numpy()
            for at, (most, i, j, stray, node, label) in enumerate(keys):
                if (most, i, j) != key:
                    done()
                    key, sides = (most, i, j), ([], [])
                shingles = values[offsets[at] : offsets[at + 1]].copy()
                sides[stray].append((node, label, shingles))
            while len(links) >= 10_000:
                yield as_batch(links[:10_000], _LINKS)
                del links[:10_000]
        done()
        if links:
            yield as_batch(links, _LINKS)

    dealt = (
        _blocks(rows, sets)
        .repartition("most", "i", "j")
        .sortWithinPartitions("most", "i", "j")
    )
    return stored(dealt.mapInArrow(found, "a long, b long").distinct(), "minmax-links")


# -- Links --------------------------------------------------------------------------------


def _sets(nodes: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The full sets of some classes, each from one document that has it: node, shingles."""
    held = classes.join(nodes, "node", "left_semi").select("node", "held.*")
    held = stored(held.withColumnRenamed("doc_id", "held_id"), "minmax-held")

    def sets(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["node"], shingle_set(row["text"]).view(np.int64)

    # The condition holds for all; Spark makes its filter of a side that has one.
    texts = _texts(documents).join(held.filter("node >= 0"), "text_name")
    texts = texts.filter(F.col("doc_id").eqNullSafe(F.col("held_id"))).select("node", "text")
    found = texts.mapInArrow(rows_in_arrow(sets, _SETS, 500), "node long, shingles array<long>")
    # Few of the texts are wanted: where they have to be shuffled, a filter on their names
    # that Spark makes of the wanted ones goes before. Repeated rows give the same set again.
    with applied(documents.sparkSession, _FILTER_FIRST):
        return stored(found.dropDuplicates(["node"]), "minmax-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough, stored: a, b."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    both = F.size(F.array_intersect("one", "two"))
    either = F.size("one") + F.size("two") - both
    close = pairs.join(two, "b").join(one, "a").filter(100 * both >= LEAST * either)
    return stored(close.select("a", "b"), "minmax-links")


def components(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The components of the linked classes, of (node, held, bands): node, component."""
    members = _shared(classes.select("node", F.explode("bands").alias("bucket")))
    sets = _sets(members.select("node").distinct(), classes, documents)
    found = _confirmed(stored(_leads(members), "minmax-pairs"), sets)
    reached = connected_components(found)
    rows = _mixed(members, reached)
    if rows.isEmpty():
        return reached
    more = _stray_links(rows, sets)
    return reached if more.isEmpty() else connected_components(found.unionAll(more))


def near_duplicates(documents: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``rows`` divides ``PERMUTATIONS``. Fewer values to a band find less similar sets, and more
    pairs to confirm.
    """
    prints = stored(signatures(documents, rows), "minmax-prints")
    first = F.struct("doc_id", "text_name")
    classes = (
        prints.filter("n_shingles > 0")
        .groupBy("set1", "set2")
        .agg(
            F.min("doc_id").alias("low"),
            F.min(first).alias("held"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "minmax-classes")
    reached = components(classes, documents)
    members = stored(classes.select("node", "low").join(reached, "node"), "minmax-linked")
    lowest = members.groupBy("component").agg(F.min("low").alias("lowest"))
    linked = members.join(stored(lowest, "minmax-lowest"), "component").select("node", "lowest")
    linked = stored(linked, "minmax-components")
    ids = classes.join(linked, "node", "left").select(
        "set1", "set2", F.lit(True).alias("known"), F.coalesce("lowest", "low").alias("lowest")
    )
    component = F.when(F.col("known"), F.col("lowest")).otherwise(F.col("doc_id"))
    return (
        prints.join(stored(ids, "minmax-ids"), ["set1", "set2"], "left")
        .withColumn("component_id", component)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
