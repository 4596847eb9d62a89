"""Small tables that hold what the corpus operators must stand: nulls in any column, empty
and long texts, ties, repeated rows, and columns whose names clash with working columns."""

from __future__ import annotations

import random
import re

DOCUMENT_DDL = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use while they work.
CLASHING = (
    "key", "words", "row", "size", "rank", "tie", "plan", "copies", "score", "name", "toxicity",
    "source_size", "target", "fingerprint", "component_id", "hash", "spans", "start", "u", "mix",
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):03d}{'aeiou'[rng.randrange(5)]}" for _ in range(n))


PASSAGE = prose(1, 70)


def document_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars), ids in no order."""
    long_text = prose(2, 12_000, 5000) + "\n" + PASSAGE
    rows = [
        (7, prose(10, 120), "en", "a", 1),
        (3, prose(10, 120), "en", "a", 1),  # an exact copy with a smaller id
        (3, prose(10, 120), "en", "a", 1),  # and a repeated row
        (11, prose(10, 119) + " end", "en", "b", None),  # a near copy
        (12, "Intro here. " + PASSAGE + " tail one", "en", "b", 5),
        (5, prose(11, 40) + " " + PASSAGE + "\n" + prose(12, 30), "de", "b", 5),
        (14, PASSAGE.upper(), "de", None, 5),
        (20, long_text, "fr", "c", None),
        (21, "", "fr", "c", 0),
        (22, None, "fr", "c", None),
        (23, " \n\t ", None, "c", 4),
        (24, "one", None, None, 3),
        (25, "two words", "en", "a", 9),
        (26, "same " * 300, "en", "a", 9),
        (27, "naïve café x   日本語 🙂 done " * 20, "fr", "d", 9),
        (None, prose(10, 120), "en", "a", 1),  # a copy without an id
        (None, prose(30, 80), None, "d", 1),
        (None, prose(30, 80), None, "d", 1),
        (28, None, None, None, None),
    ]
    rows += [(100 + i, prose(200 + i, 60 + i), "en", "abcd"[i % 4], 1) for i in range(40)]
    return rows


def documents(spark, rows: list[tuple] | None = None, clashing: bool = True):
    frame = spark.createDataFrame(document_rows() if rows is None else rows, DOCUMENT_DDL)
    frame = frame.repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        frame = frame.select("*", *(F.lit("x").alias(name) for name in CLASHING))
    return frame


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def as_tuples(frame, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
