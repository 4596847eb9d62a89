"""SimHash near-duplicates, linked by a hierarchical index over Gray-ordered fingerprints.

Fingerprints of ``BITS`` bits link at ``DISTANCE`` or fewer differing bits. Equal ones are
one fingerprint from the start, so copies cost nothing beyond their grouping.

Candidates: the bits are cut into ``DISTANCE + 1`` blocks; two linked fingerprints agree in
one of them. Each fingerprint goes into one bucket per block, turned so that the block comes
first. A bucket goes by as many first bits of the block as leave it some ``RUN`` fingerprints,
so their number grows with that of the fingerprints, up to ``BLOCKS * 2**16``. What holds more
than ``LARGE`` is cut by blocks of the bits left over, and again, down to ``LEAST_BITS``: two
that are linked and agree in all blocks so far differ in ``DISTANCE`` of the other bits at
most. A family of near copies of whatever size so becomes many runs.

Index: a bucket is sorted by Gray rank, in which neighbours differ in few bits. Runs of
``FAN`` fingerprints share a masked bit pattern, which is factored into a node; runs of
nodes make the next level, and so on. The search compares nodes with nodes from the top:
the bits that both masks hold and in which the patterns differ add up on the way down, and
a pair of groups is dropped as a whole once they are more than ``DISTANCE``. So is a pair
whose members are all linked already. Each bucket reports how many pairs of fingerprints it
compared, and how many it was spared; the sums are logged.

A bucket gives a chain through each of its groups of linked fingerprints, never all pairs.
Components of these links are found in Spark.

Defined results: see the contract for texts of few or no words; no text has none. Documents
without an id are linked like any other; a group in which no document has one has no
component id. Rows of one id with different texts are different documents. Repeated rows
are copies. Other columns are kept or not read.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_rows, rows_in_arrow, stored
from tripmart.llm.components import connected_components

# Fixed values of the contract.
SHINGLE = 3
HASH_SEED = 42
BITS = 64
DISTANCE = 3

BLOCKS = DISTANCE + 1
BLOCK_BITS = BITS // BLOCKS

RUN = 4096
LARGE = 16_384
LEAST_BITS = 16  # fewer can tell no more than 65,536 fingerprints apart
FAN = 16
PAIRS_AT_ONCE = 2048

_PRINTS = pa.schema([("doc_id", pa.int64()), ("tie", pa.string()), ("print", pa.int64())])
_LINKS = pa.schema([(name, pa.int64()) for name in ("a", "b", "compared", "spared")])
_LINKS_DDL = "a long, b long, compared long, spared long"

log = logging.getLogger(__name__)


# -- Fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included."""
    # Bytes fold and split by ASCII alone.
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    hashed = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([hashed(joined, HASH_SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.fromiter(
        (hashed(joined[a:b], HASH_SEED) for a, b in spans),
        dtype=np.uint64,
        count=len(found) - words + 1,
    )


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The bits that more than half of the hashes have, as an unsigned number."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _tie() -> Column:
    """Tells documents of one id, or without an id, apart."""
    return F.sha1(F.coalesce("text", F.lit("")))


def fingerprints(
    documents: DataFrame, words: int = SHINGLE, tie: Column | None = None
) -> DataFrame:
    """One row per document: doc_id, tie (empty unless given), print (as a signed number)."""
    tie = F.lit("") if tie is None else tie

    def prints(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["doc_id"], row["tie"], _signed(fingerprint(row["text"], words))

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", tie.alias("tie")
    )
    return texts.mapInArrow(rows_in_arrow(prints, _PRINTS), "doc_id long, tie string, print long")


# -- The index of a bucket --------------------------------------------------------------


def index_levels(sorted_prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask) of the nodes of each level, fingerprints first.

    The mask marks the bits in which all members of a node agree.
    """
    both = either = sorted_prints
    levels = [(both, np.full(len(both), ~np.uint64(0)))]
    while len(both) > FAN:
        starts = np.arange(0, len(both), FAN)
        both = np.bitwise_and.reduceat(both, starts)
        either = np.bitwise_or.reduceat(either, starts)
        levels.append((both, ~(both ^ either)))
    return levels


def _near(level: tuple, a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Whether the bits that both nodes fix differ in few enough places."""
    pattern, mask = level
    return np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance


def _children(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of pairs of nodes; members of one node once per pair."""
    step = np.arange(FAN)
    left = np.broadcast_to((a[:, None] * FAN + step)[:, :, None], (len(a), FAN, FAN)).reshape(-1)
    right = np.broadcast_to((b[:, None] * FAN + step)[:, None, :], (len(b), FAN, FAN)).reshape(-1)
    real = (left < size) & (right < size) & (left <= right)
    return left[real], right[real]


class _Groups:
    """The groups of a bucket's fingerprints, by their smallest place."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = self.root[a], self.root[b]
            apart = low != high
            if not apart.any():
                return
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(self.root, np.maximum(low, high), np.minimum(low, high))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]

    def one_group(self, level: int) -> np.ndarray:
        """The group of each node whose members are all in one, else -1."""
        starts = np.arange(0, len(self.root), FAN**level)
        low = np.minimum.reduceat(self.root, starts)
        return np.where(low == np.maximum.reduceat(self.root, starts), low, -1)


def linked_groups(
    sorted_prints: np.ndarray, distance: int = DISTANCE
) -> tuple[np.ndarray, int]:
    """For distinct fingerprints in Gray order, the first place of each one's group, and how
    many pairs of them were compared."""
    compared = 0
    levels = index_levels(sorted_prints)
    groups = _Groups(len(sorted_prints))
    stack = [(len(levels) - 1, *np.triu_indices(len(levels[-1][0])))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS_AT_ONCE and level:
            stack.append((level, a[PAIRS_AT_ONCE:], b[PAIRS_AT_ONCE:]))
            a, b = a[:PAIRS_AT_ONCE], b[:PAIRS_AT_ONCE]
        near = _near(levels[level], a, b, distance)
        if not level:
            compared += len(a) - int((a == b).sum())
            groups.link(a[near], b[near])
            continue
        a, b = a[near], b[near]
        one = groups.one_group(level)
        joined = (one[a] == one[b]) & (one[a] >= 0)
        a, b = _children(a[~joined], b[~joined], len(levels[level - 1][0]))
        if len(a):
            stack.append((level - 1, a, b))
    return groups.root, compared


# -- Links over Spark -------------------------------------------------------------------


def _turned(bits: Column, by: int) -> Column:
    if not by:
        return bits
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by))


def gray_rank(bits: Column) -> Column:
    """The place of a bit pattern in the Gray sequence."""
    rank, step = bits, 1
    while step < BITS:
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
        step *= 2
    return rank


def bucket_bits(fingerprints: int) -> int:
    """The first bits of a block that a bucket goes by, so that it holds ``RUN`` at most where
    fingerprints are spread evenly."""
    return min(BLOCK_BITS, max(0, math.ceil(math.log2(max(fingerprints, 1) / RUN))))


def _buckets(prints: DataFrame, bits: int) -> DataFrame:
    """Every fingerprint in its buckets: bucket, turned."""
    turns = []
    for i in range(BLOCKS):
        turned = _turned(F.col("print"), i * BLOCK_BITS)
        first = F.shiftrightunsigned(turned, BITS - bits) if bits else F.lit(0).cast("long")
        bucket = first + F.lit(i << BLOCK_BITS)
        turns.append(F.struct(bucket.alias("bucket"), turned.alias("turned")))
    return prints.select(F.inline(F.array(*turns)))


def _large(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The keys of more than ``least`` rows, stored, and marked ``large``."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return stored(counted.select(*keys, F.lit(True).alias("large")), "simhash-large")


def _cut(rows: DataFrame, bits: int) -> DataFrame:
    """Cut the rows marked ``large`` by the blocks of their ``bits`` bits of rest.

    ``inner`` tells the runs of a bucket apart: a one, and the number and value of the block
    of each cut. The blocks need not hold all bits: no more than ``DISTANCE`` can differ.
    """
    width = bits // BLOCKS
    rest, inner = F.col("rest"), F.col("inner")
    blocks = []
    for i in range(BLOCKS):
        low = i * width
        value = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << width) - 1))
        above = F.lit(0).cast("long")
        if low + width < BITS:
            above = F.shiftleft(F.shiftrightunsigned(rest, low + width), low)
        blocks.append(
            F.struct(
                F.shiftleft(inner, width + 2)
                .bitwiseOR(F.lit(i << width))
                .bitwiseOR(value)
                .alias("inner"),
                above.bitwiseOR(rest.bitwiseAND(F.lit((1 << low) - 1))).alias("rest"),
            )
        )
    whole = F.array(F.struct(inner.alias("inner"), rest.alias("rest")))
    cut = F.when(F.col("large"), F.array(*blocks)).otherwise(whole)
    return rows.select("bucket", "turned", F.inline(cut))


def _dealt(prints: DataFrame, fingerprints: int) -> DataFrame:
    """Every fingerprint in its runs: bucket, inner, rest, turned."""
    first = bucket_bits(fingerprints)
    bits = BITS - first
    rest = F.col("turned")
    if first:
        rest = rest.bitwiseAND(F.lit((1 << bits) - 1))
    rows = _buckets(prints, first)
    rows = rows.withColumn("inner", F.lit(1).cast("long")).withColumn("rest", rest)
    while bits > LEAST_BITS:
        # Only what has been cut before can still be large.
        cut = rows if bits == BITS - first else rows.filter("inner > 1")
        large = _large(cut, ["bucket", "inner"], LARGE)
        if large.isEmpty():
            break
        rows = _cut(rows.join(large, ["bucket", "inner"], "left"), bits)
        bits -= bits // BLOCKS
    return rows


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, turned fingerprints) of each run of equal bucket and inner."""
    kept: list[np.ndarray] = []
    key = None
    for batch in batches:
        bucket, inner, turned = (batch.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(inner) != 0)) + 1
        for low, high in zip([0, *starts.tolist()], [*starts.tolist(), len(bucket)], strict=True):
            here = (int(bucket[low]), int(inner[low]))
            if here != key:
                if kept:
                    yield key[0], np.concatenate(kept)
                key, kept = here, []
            kept.append(turned[low:high].astype(np.uint64))
    if kept:
        yield key[0], np.concatenate(kept)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links along each group of a bucket, as fingerprints turned back, and for each bucket the
    numbers of pairs that were compared, and that were not."""
    found: list[np.ndarray] = []
    counts: list[tuple[int, int]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        pairs = np.hstack([*found, np.zeros((2, 0), dtype=np.int64)])
        n, m = pairs.shape[1], len(counts)
        compared, spared = np.array(counts, dtype=np.int64).reshape(-1, 2).T
        columns = [
            *(pa.concat_arrays([pa.array(c), pa.nulls(m, pa.int64())]) for c in pairs),
            *(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c)]) for c in (compared, spared)),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_LINKS)

    for bucket, turned in _runs(b for b in batches if b.num_rows):
        n = len(turned)
        if n < 2:
            continue
        root, compared = linked_groups(turned)
        counts.append((compared, n * (n - 1) // 2 - compared))
        order = np.argsort(root, kind="stable")
        same = root[order][1:] == root[order][:-1]
        by = np.uint64((bucket >> BLOCK_BITS) * BLOCK_BITS)
        back = turned if not by else (turned >> by) | (turned << (np.uint64(BITS) - by))
        pairs = np.stack((back[order[:-1][same]], back[order[1:][same]])).view(np.int64)
        found.append(pairs)
        size += pairs.shape[1] + 1
        if size > 10_000:
            yield batch()
            found.clear()
            counts.clear()
            size = 0
    if counts:
        yield batch()


def searched(prints: DataFrame) -> DataFrame:
    """Links that join what the distance links, among distinct fingerprints (a, b), stored,
    beside one row per bucket with the pairs compared and spared."""
    dealt = (
        _dealt(prints, prints.count())
        .withColumn("rank", gray_rank(F.col("turned")))
        .repartition("bucket", "inner")
        .sortWithinPartitions("bucket", "inner", "rank")
        .select("bucket", "inner", "turned")
    )
    return stored(dealt.mapInArrow(_chains, _LINKS_DDL), "simhash-links")


def links(prints: DataFrame) -> DataFrame:
    """The links of ``searched``: a, b."""
    found = searched(prints)
    if log.isEnabledFor(logging.INFO):
        compared, spared = found.agg(F.sum("compared"), F.sum("spared")).first()
        log.info("%s pairs of fingerprints compared, %s spared by the index", compared, spared)
    return found.filter("a is not null").select("a", "b")


def classes(prints: DataFrame) -> DataFrame:
    """One row per fingerprint: print, keeper. The keeper is the first document of all that
    the fingerprint reaches, a struct of (no_id, doc_id, tie); ids come before no ids."""
    first = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"),
        F.col("tie").alias("tie"),
    )
    distinct = stored(prints.groupBy("print").agg(F.min(first).alias("own")), "simhash-distinct")
    reached = connected_components(links(distinct)).withColumnRenamed("node", "print")
    members = stored(distinct.join(reached, "print"), "simhash-members")
    first_of = stored(
        members.groupBy("component").agg(F.min("own").alias("keeper")), "simhash-first"
    )
    keepers = members.join(first_of, "component").select("print", "keeper")
    keepers = stored(keepers, "simhash-keepers")
    return distinct.join(keepers, "print", "left").select(
        "print", F.coalesce("keeper", "own").alias("keeper")
    )


def near_duplicates(documents: DataFrame, words: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = stored(fingerprints(documents, words), "simhash-prints")
    found = stored(classes(prints), "simhash-classes")
    return prints.join(found, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("keeper.doc_id").alias("component_id"),
    )


def without_near_duplicates(documents: DataFrame, words: int = SHINGLE) -> DataFrame:
    """One document of each group, that of the smallest id, with its own columns.

    Id and text name a document, so a name is of one fingerprint and one group, whatever
    the ids.
    """
    prints = stored(fingerprints(documents, words, _tie()), "simhash-prints")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "tie")
    keepers = classes(prints).select("keeper.doc_id", "keeper.tie").distinct()
    kept = stored(keepers.select(name.alias("name")), "simhash-kept")
    rows = documents.select(
        as_rows(documents), F.col("doc_id").cast("long").alias("doc_id"), _tie().alias("tie")
    ).select("row", name.alias("name"))
    # Repeated rows have one name, and are in one place after the join.
    return rows.join(kept, "name", "left_semi").dropDuplicates(["name"]).select("row.*")
