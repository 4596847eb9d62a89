"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Items and documents are sequences of words. A window of ``WINDOW`` words holds
``WINDOW - GRAM + 1`` grams of ``GRAM`` words, and winnowing keeps the smallest of their
hashes. A window that occurs on both sides has the same grams there, so the same smallest
hash: joining the kept hashes finds every shared window, and with it every longer span.

1. Items give their kept hashes and their windows.
2. Texts give their kept hashes. Those joined with the hashes of the items tell which
   texts have a hit; only these go on, each once however many documents share it.
3. Hits are extended: the windows that cover one are looked up among the windows of the
   items, by their words. So an equal hash alone never counts.
4. The windows found give the words that are hit and the items of a text, and the text
   gives them to its documents.

An item shorter than a window is one window of its own length. It is found by one gram of
``min(GRAM, length)`` words among all grams of that many words in a text; that costs more
hashes for each such gram length that occurs in the benchmark, and nothing if there is none.

Which side of a join is broadcast, if any, is left to the planner, by size.

Defined results: no text has no words, and no words have no hits; repeated rows get a
result each; items without words match nothing, and items without an id count as one item
with an empty name. Other columns are not read, or kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.frames import union_all
from tripmart.llm.common import as_rows, stored

# Fixed values of the contract: what lies between the words of folded text (and of text of
# any case), and how many words make a window.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10

# Words of a gram. Longer grams occur on both sides by chance less often, so that fewer texts
# are looked at twice; shorter ones leave fewer hashes per text.
GRAM = 7

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALL = 1 << 30


def folded_words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(folded, BETWEEN), "")


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), BETWEEN_ANY_CASE)
    return F.size(F.array_remove(words, "")).cast("long")


def text_key(text: Column) -> Column:
    """What stands for a text: copies share it."""
    return F.unhex(F.sha1(F.coalesce(text, F.lit(""))))


def _ahead(column: str, by: int) -> Column:
    return F.slice(F.col(column), by + 1, _ALL)


def with_grams(df: DataFrame, length: int) -> DataFrame:
    """Add hashes ``g1`` to ``g<length>``: of the runs of so many words at each position.

    Needs ``words``. Runs that would pass the end are hashed as far as they go. Each step
    is a column of its own, so that none is evaluated twice. For the same reason what comes
    of them is unfolded by outer functions: the others first test whether there is anything
    to unfold, and the planner moves that test, with all steps in it, to the scan.
    """
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    for n in range(2, length + 1):
        half = 1 << (n - 1).bit_length() - 1  # a run is a shorter run and what follows it
        df = df.withColumn(
            f"g{n}",
            F.zip_with(f"g{half}", _ahead(f"g{n - half}", half), lambda a, b: F.xxhash64(a, b)),
        )
    return df


def with_minima(df: DataFrame, column: str, width: int) -> DataFrame:
    """Replace hashes by the smallest of each and the ``width - 1`` behind it."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        least = F.zip_with(column, _ahead(column, step), lambda a, b: F.least(a, b))
        df = df.withColumn(column, least)
        reach += step
    return df


def kept_hashes(df: DataFrame, short: Sequence[int]) -> DataFrame:
    """Replace ``words`` by ``hashes``, the fingerprint of a text.

    ``short`` has the lengths of items shorter than a window.
    """
    df = with_grams(df, GRAM)
    whole = sorted({min(GRAM, n) for n in short})
    df = df.withColumn("kept", F.col(f"g{GRAM}"))
    df = with_minima(df, "kept", WINDOW - GRAM + 1)
    # Without the runs past the end: the last words alone are common to very many texts.
    kept = _whole_runs("kept", WINDOW)
    every = F.concat(kept, *(_whole_runs(f"g{n}", n) for n in whole))
    grams = [f"g{n}" for n in range(1, GRAM + 1)]
    return df.withColumn("hashes", F.array_distinct(every)).drop("words", "kept", *grams)


def _whole_runs(column: str, length: int) -> Column:
    """The hashes of the places from which so many words follow."""
    return F.slice(F.col(column), F.lit(1), F.greatest(F.size("words") - length + 1, F.lit(0)))


def _runs(starts: Column, length: Column | int) -> Column:
    """The words of a run at each start, joined by spaces."""
    return F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, length), " "))


def item_windows(items: DataFrame) -> DataFrame:
    """Every window of every item: item_id, window, length."""
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0)))
    return (
        items.filter(n > 0)
        .withColumn("length", F.least(n, F.lit(WINDOW)))
        .select("item_id", "length", F.explode(_runs(starts, F.col("length"))).alias("window"))
        .distinct()
    )


def item_hashes(items: DataFrame, short: Sequence[int]) -> DataFrame:
    """The distinct fingerprints of the items: hash."""
    long_items = items.filter(F.size("words") >= WINDOW)
    found = [kept_hashes(long_items, []).select(F.explode("hashes").alias("hash"))]
    for n in short:
        gram = min(GRAM, n)
        one = with_grams(items.filter(F.size("words") == n), gram)
        # The last grams run past the end; the first one never does.
        found.append(one.select(F.col(f"g{gram}")[0].alias("hash")))
    return union_all(found).distinct()


def _starts(at: Column, n_words: Column, length: int, gram: int) -> Column:
    """Where windows of a length begin that cover a gram at one of the positions ``at``."""
    inside = F.filter(at, lambda p: p + gram <= n_words)
    runs = F.transform(
        inside,
        lambda p: F.sequence(
            F.greatest(p - (length - gram), F.lit(0)),
            # A window that would pass the end of the text begins at the last place.
            F.greatest(F.least(p, n_words - length), F.lit(0)),
        ),
    )
    return F.array_distinct(F.flatten(runs))


def found_windows(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The windows of items in texts: key, start, length, window, all distinct.

    ``texts`` has key and text, ``benchmark`` the stored item_id and words.
    """
    short = [
        r[0]
        for r in benchmark.select(F.size("words").alias("n"))
        .filter(f"n between 1 and {WINDOW - 1}")
        .distinct()
        .collect()  # WINDOW - 1 numbers at most
    ]
    hashes = stored(item_hashes(benchmark, short), "benchmark-hashes")
    windows = stored(
        item_windows(benchmark).select("window", "length").distinct(), "benchmark-windows"
    )
    hit_keys = (
        kept_hashes(texts.select("key", folded_words(F.col("text")).alias("words")), short)
        .select("key", F.explode_outer("hashes").alias("hash"))
        .join(hashes, "hash", "left_semi")
        .select("key")
        .distinct()
    )
    hit_texts = texts.join(stored(hit_keys, "benchmark-hits"), "key", "left_semi")
    # Grouped by another name for the key: so the planner may split the join where very many
    # documents share a text, and copies meet in the tasks before they are shuffled again.
    suspects = stored(
        hit_texts.groupBy(F.hex("key").alias("name"))
        .agg(F.first("text").alias("text"))
        .select(F.unhex("name").alias("key"), folded_words(F.col("text")).alias("words")),
        "benchmark-suspects",
    )
    shapes = [(WINDOW, GRAM), *((n, min(GRAM, n)) for n in short)]
    n_words = F.size("words")
    found = []
    for gram in sorted({g for _, g in shapes}):
        at = (
            with_grams(suspects, gram)
            .select("key", F.posexplode_outer(f"g{gram}").alias("at", "hash"))
            .join(hashes, "hash", "left_semi")
            .groupBy("key")
            .agg(F.collect_list("at").alias("at"))
        )
        marked = suspects.join(at, "key")
        for length in sorted(n for n, g in shapes if g == gram):
            starts = marked.filter(n_words >= length).withColumn(
                "starts", _starts(F.col("at"), n_words, length, gram)
            )
            runs = F.arrays_zip(
                F.col("starts").alias("start"), _runs(F.col("starts"), length).alias("window")
            )
            found.append(
                starts.select("key", F.inline_outer(runs).alias("start", "window")).withColumn(
                    "length", F.lit(length)
                )
            )
    return union_all(found).join(windows, ["window", "length"], "left_semi")


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The texts that hold windows of items: key, n_hit, n_items, items_sha256."""
    items = stored(
        benchmark.select(
            F.col("item_id").cast("string").alias("item_id"),
            folded_words(F.col("text")).alias("words"),
        ),
        "benchmark-items",
    )
    texts = documents.select(text_key(F.col("text")).alias("key"), "text")
    found = stored(found_windows(texts, items), "benchmark-found")
    end, before = F.col("start") + F.col("length"), F.max(F.col("start") + F.col("length"))
    in_order = Window.partitionBy("key").orderBy("start", "length")
    reached = before.over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(end - F.greatest("start", F.coalesce(reached, F.lit(0))), F.lit(0))
    words = (
        found.withColumn("fresh", fresh)
        .groupBy("key")
        .agg(F.sum("fresh").cast("long").alias("n_hit"))
    )
    names = F.sort_array(F.collect_set(F.coalesce("item_id", F.lit(""))))
    named = (
        found.select("key", "window", "length")
        .distinct()
        .join(item_windows(items), ["window", "length"])
        .groupBy("key")
        .agg(names.alias("names"))
    )
    return words.join(named, "key").select(
        "key",
        "n_hit",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names"), 256).alias("items_sha256"),
    )


def contaminated_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = stored(contamination(documents, benchmark), "contamination")
    text = F.col("text")
    keyed = documents.select(
        "doc_id", text_key(text).alias("key"), word_count(text).alias("n_words")
    )
    none = F.sha2(F.lit(""), 256)
    return keyed.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of an item, with their own columns."""
    found = stored(contamination(documents, benchmark).select("key"), "contaminated")
    rows = documents.select(as_rows(documents), text_key(F.col("text")).alias("key"))
    return rows.join(found, "key", "left_anti").select("row.*")
