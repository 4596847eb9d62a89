"""Spelling variants: words of a corpus that are one edit apart, grouped by their commonest form.

Vocabulary: runs of Latin letters with A-Z in lower case, counted over all texts. Tasks count
their own texts first and send a word once each time their table is full.

Groups: of a word cut in two, one edit leaves one half alone. A word of L code points looks for
words of L or L + 1 that share its first half, and for such as share its last; so it meets them
in the group of (L, half). A group of more than ``LARGE`` words is cut again in the same way
over what its words do not share, and again, until one place is left, of which there are no
more words than letters for it and for one more. A frequent beginning or ending so becomes
many groups.

Search: a group is a sorted list. For each word, the list is scanned with the rows of the edit
matrix, of which only the band of one off the diagonal is kept, one row per code point of the
word at hand. The rows of the prefix shared with the word before (LCP) are used again. Where a
row exceeds one edit throughout, all words that share the prefix up to it are skipped.

Defined results: no text has no runs. The checksum that plants typing errors takes a document
without an id as one whose id is empty. Repeated rows count again. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_batch, batch_rows, rows_in_arrow, stored

# Fixed values of the contract.
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
PLANTED = 199  # one in so many words of a document has a letter taken out
LEAST_LENGTH = 6
LEAST_COUNT = 5
DOMINANCE = 5  # a form is so many times as frequent

LARGE = 256
TABLE_WORDS = 200_000

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())]
)


# -- Vocabulary ---------------------------------------------------------------------------


def text_words(text: str | None) -> list[str]:
    """The runs of letters of a text, with A-Z in lower case."""
    # Bytes fold ASCII alone.
    lower = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return RUN.findall(lower)


def planted_errors(doc_id: int | None, words: set[str]) -> dict[str, str]:
    """What takes the place of those words that the checksum picks."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    errors = {}
    for word in words:
        check = zlib.crc32(word.encode(), seed)
        if not check % PLANTED:
            at = check % len(word)
            errors[word] = word[:at] + word[at + 1 :]
    return errors


def vocabulary(documents: DataFrame, planted: bool = False) -> DataFrame:
    """Words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences: word, n.

    ``planted`` puts the typing errors of the contract into the texts.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter[str] = Counter()

        def full() -> Iterator[pa.RecordBatch]:
            rows = [(w, n) for w, n in table.items() if n > 0 and len(w) >= LEAST_LENGTH]
            table.clear()
            for at in range(0, len(rows), 10_000):
                yield as_batch(rows[at : at + 10_000], _COUNTS)

        for batch in batches:
            for row in batch_rows(batch):
                words = text_words(row["text"])
                table.update(words)
                if planted:
                    for word, error in planted_errors(row["doc_id"], set(words)).items():
                        n = words.count(word)
                        table[word] -= n
                        table[error] += n
                if len(table) >= TABLE_WORDS:
                    yield from full()
        yield from full()

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = texts.mapInArrow(counted, "word string, n long").groupBy("word")
    return counts.agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# -- Search of a sorted list --------------------------------------------------------------


def shared_prefixes(words: list[str]) -> list[int]:
    """The length of the prefix that each word shares with the one before it."""
    found = [0] * len(words)
    for i in range(1, len(words)):
        one, two = words[i - 1], words[i]
        n = min(len(one), len(two))
        at = 0
        while at < n and one[at] == two[at]:
            at += 1
        found[i] = at
    return found


def _next_shorter(lcp: list[int]) -> list[int]:
    """For each place, the next one whose shared prefix is shorter."""
    found = [len(lcp)] * len(lcp)
    open_places: list[int] = []
    for i, n in enumerate(lcp):
        while open_places and lcp[open_places[-1]] > n:
            found[open_places.pop()] = i
        open_places.append(i)
    return found


def near_in_list(
    query: str, words: list[str], lcp: list[int], shorter: list[int]
) -> Iterator[int]:
    """The places of the words of a sorted list that are one edit from the query, and as long
    as it or one longer.

    A row holds the edits between a prefix of the word and the prefixes of the query that are
    one shorter, as long, and one longer, up to 2.
    """
    length = len(query)
    letters = "\0" + query + "\0\0\0"  # no word has this letter
    rows = [(2, 0, 1)] + [(2, 2, 2)] * (length + 1)
    known = 0  # rows that belong to the word at hand
    at, end = 0, len(words)
    while at < end:
        word = words[at]
        size = len(word)
        depth = known
        less, same, more = rows[depth]
        while depth < size:
            letter = word[depth]
            # Columns depth, depth + 1 and depth + 2 of the matrix, letter before each.
            one = less + (letter != letters[depth])
            if same + 1 < one:
                one = same + 1
            two = same + (letter != letters[depth + 1])
            if more + 1 < two:
                two = more + 1
            if one + 1 < two:
                two = one + 1
            three = more + (letter != letters[depth + 2])
            if two + 1 < three:
                three = two + 1
            depth += 1
            if one > 1 and two > 1 and three > 1:
                break
            less, same, more = rows[depth] = one, two, three
        else:
            if size == length:
                if same == 1:
                    yield at
            elif size == length + 1 and less == 1:
                yield at
            at += 1
            if at < end:
                known = min(lcp[at], size)
            continue
        # No word that shares this prefix can be near.
        at += 1
        while at < end and lcp[at] >= depth:
            at = shorter[at]
        if at < end:
            known = min(lcp[at], depth - 1)


def near_pairs(group: list[tuple[str, int]], length: int) -> Iterator[tuple[int, int]]:
    """Places of the near words of a sorted group of (word, n); of two words as long, each is
    given as the other's, and a longer one once, behind the shorter."""
    words = [word for word, _ in group]
    lcp = shared_prefixes(words)
    shorter = _next_shorter(lcp)
    for place, word in enumerate(words):
        if len(word) == length:
            for other in near_in_list(word, words, lcp, shorter):
                yield place, other


# -- Groups over Spark --------------------------------------------------------------------


def _keyed(rows: DataFrame, ways: list[tuple[Column, Column]]) -> DataFrame:
    """Rows (length, word, n) in the groups of the words that share ``head`` first code points
    and ``tail`` last ones, in several ways; ``size`` is the number of code points of a word."""
    entries = F.array(*(F.struct(head.alias("head"), tail.alias("tail")) for head, tail in ways))
    size = F.char_length("word")
    return rows.select("length", "word", "n", F.inline(entries)).select(
        "length",
        "head",
        "tail",
        F.col("word").substr(F.lit(1), F.col("head")).alias("first"),
        F.col("word").substr(size - F.col("tail") + 1, F.col("tail")).alias("last"),
        "word",
        "n",
    )


_GROUP = ["length", "head", "tail", "first", "last"]


def _grouped(words: DataFrame) -> DataFrame:
    """Every word in its groups, none of which is large unless it cannot be cut: the columns
    of ``_GROUP``, word, n."""
    size = F.char_length("word")
    lengths = F.filter(F.array(size, size - 1), lambda length: length >= LEAST_LENGTH)
    length = F.col("length")
    half = (length / 2).cast("int")
    rows = _keyed(
        words.select(F.explode(lengths).alias("length"), "word", "n"),
        [(half, F.lit(0)), (F.lit(0), length - half)],
    )
    done = None
    while True:
        several = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("words"))
        several = stored(several.filter("words > 1"), "spelling-groups")
        rows = stored(rows.join(several, _GROUP), "spelling-rows")
        middle = length - F.col("head") - F.col("tail")
        large = (F.col("words") > LARGE) & (middle > 1)
        small = rows.filter(~large).drop("words")
        done = small if done is None else done.unionAll(small)
        if several.filter(large).isEmpty():
            return done
        part = (middle / 2).cast("int")
        rows = _keyed(
            rows.filter(large).select("length", "head", "tail", "word", "n"),
            [
                (F.col("head") + part, F.col("tail")),
                (F.col("head"), F.col("tail") + middle - part),
            ],
        )


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of near words, each in both directions: word, n, near, near_n."""

    def searched(rows: Iterator[dict]) -> Iterator[tuple]:
        group: list[tuple[str, int]] = []
        key = None

        def done() -> Iterator[tuple]:
            for one, two in near_pairs(group, key[0]):
                yield *group[one], *group[two]
                if len(group[two][0]) > key[0]:
                    yield *group[two], *group[one]

        for row in rows:
            here = tuple(row[c] for c in _GROUP)
            if here != key:
                if len(group) > 1:
                    yield from done()
                key, group = here, []
            group.append((row["word"], row["n"]))
        if len(group) > 1:
            yield from done()

    return (
        _grouped(words)
        .repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP, "word")
        .mapInArrow(
            rows_in_arrow(searched, _NEAR), "word string, n long, near string, near_n long"
        )
        .distinct()
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Follow forms to the last: word, root. ``forms`` has word and form, never NULL.

    Each round doubles the steps taken. A form is ``DOMINANCE`` times as frequent as its word,
    so rounds grow with the logarithm of the logarithm of the corpus.
    """
    roots = stored(forms.withColumnRenamed("form", "root"), "spelling-roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("upper"))
        step = roots.join(above, "root", "left")
        step = stored(
            step.select(
                "word",
                F.coalesce("upper", "root").alias("root"),
                F.col("upper").isNotNull().alias("moved"),
            ),
            "spelling-roots",
        )
        roots = step.drop("moved")
        if step.filter("moved").isEmpty():
            return roots


def variants(documents: DataFrame, planted: bool = False) -> DataFrame:
    """One row per word of the vocabulary: word, n, n_near, form, form_n, root.

    The form is the near word of largest count (ties: the smallest), if that is at least
    ``DOMINANCE`` times as frequent.
    """
    words = stored(vocabulary(documents, planted), "spelling-words")
    commonest = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form")))
    judged = (
        near_words(words)
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), commonest.alias("best"))
        .withColumn("form_n", -F.col("best.rank"))
        .withColumn("dominant", F.col("form_n") >= DOMINANCE * F.col("n"))
        .select(
            "word",
            "n_near",
            F.when(F.col("dominant"), F.col("best.form")).alias("form"),
            F.when(F.col("dominant"), F.col("form_n")).alias("form_n"),
        )
    )
    judged = stored(judged, "spelling-judged")
    roots = _roots(judged.filter("form is not null").select("word", "form"))
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
