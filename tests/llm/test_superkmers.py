import hashlib
import random

import pytest
from corpus_cases import PASSAGE, document_rows, documents, prose, words_of

from tripmart.llm import superkmers


def brute(rows, window=50):
    lowest = {}
    for doc_id, text, *_ in rows:
        words = words_of(text)
        for s in range(len(words) - window + 1):
            if doc_id is not None:
                w = tuple(words[s : s + window])
                lowest[w] = min(lowest.get(w, doc_id), doc_id)
    found = []
    for doc_id, text, *_ in rows:
        words, gone = words_of(text), set()
        for s in range(len(words) - window + 1):
            if doc_id is not None and lowest[tuple(words[s : s + window])] < doc_id:
                gone.update(range(s, s + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc_id, len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=repr)


def cut(spark, rows):
    found = superkmers.without_repeats(documents(spark, rows)).collect()
    return sorted(map(tuple, found), key=repr)


MORE = [
    (300, "same " * 700 + PASSAGE, "en", "a", 1),
    (301, "x " * 10 + "same " * 400 + " y", "en", "a", 1),
    (302, PASSAGE + " " + PASSAGE, "en", "a", 1),
    (303, " ".join(PASSAGE.split()[:50]), "en", "a", 1),
    (304, " ".join(PASSAGE.split()[:49]), "en", "a", 1),
]


@pytest.mark.parametrize("large", [1, 1000])
def test_documents(spark, monkeypatch, large):
    """Both for buckets that are sorted and for those dealt out by window."""
    monkeypatch.setattr(superkmers, "LARGE", large)
    rows = document_rows() + MORE
    assert cut(spark, rows) == brute(rows)


def test_a_passage_that_many_documents_share(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "LARGE", 10)
    rng = random.Random(2)
    rows = [
        (i, prose(i, rng.randrange(60)) + " " + PASSAGE + " " + prose(500 + i, rng.randrange(60)), "en", "a", 1)
        for i in range(60)
    ]
    assert cut(spark, rows) == brute(rows)


def test_no_documents(spark):
    assert cut(spark, []) == []


def test_super_kmers_cover_every_window_once():
    words = superkmers.split_words(prose(4, 500, 30) + " same" * 400)
    found = superkmers.super_kmers(words)
    covered = [w for start, n, _ in found for w in range(start, start + n)]
    assert covered == list(range(len(words) - superkmers.WINDOW + 1))
    assert max(n for _, n, _ in found) <= superkmers.LONGEST
    minimisers = superkmers.window_minimisers(words)
    assert len(minimisers) == len(covered)
    assert len(found) < len(covered) / 4  # windows travel together
    assert superkmers.super_kmers(words[:49]) == []


def test_minimisers_depend_on_the_window_alone():
    one = superkmers.split_words(prose(1, 30) + " " + PASSAGE)
    two = superkmers.split_words(PASSAGE + " " + prose(2, 30))
    a = superkmers.window_minimisers(one)[30:].tolist()
    b = superkmers.window_minimisers(two)[: len(a)].tolist()
    assert a == b
