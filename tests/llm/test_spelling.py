import random
import re
import zlib
from collections import Counter

import pytest
from corpus_cases import document_rows, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import spelling

LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, planted):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and check % 199 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    found = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(found, key=repr)


def found(spark, rows, planted=True):
    frame = spelling.variants(documents(spark, rows), planted)
    assert frame.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, frame.collect()), key=repr)


def corpus(seed, stems=30, letters="abcé"):
    """Texts of stems and their misspellings, in very different numbers."""
    rng = random.Random(seed)
    words = []
    for _ in range(stems):
        stem = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 10)))
        n = 5 ** rng.randrange(1, 5)
        words += [stem] * n
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(stem))
            variant = stem[:at] + rng.choice(["", rng.choice(letters), stem[at] * 2]) + stem[at + 1 :]
            words += [variant] * rng.choice([1, 5, n // 5, n // 25])
    rng.shuffle(words)
    return [(i, " ".join(words[i::40]).title(), "en", "a", 1) for i in range(40)]


@pytest.mark.parametrize("planted", [False, True])
def test_messy_documents(spark, planted):
    rows = document_rows() * 5 + [(1, "Straße STRASSE strasse été Été " * 9, "de", "a", 1)]
    assert found(spark, rows, planted) == brute(rows, planted)
    assert found(spark, [], planted) == []


@pytest.mark.parametrize("large", [2, 20, 256])
def test_large_groups_are_cut_without_loss(spark, monkeypatch, large):
    monkeypatch.setattr(spelling, "LARGE", large)
    rows = corpus(large)
    expected = brute(rows, True)
    assert found(spark, rows) == expected
    assert any(form for *_, form, _, _ in expected) and any(n > 2 for _, _, n, *_ in expected)


def test_roots_follow_forms_to_the_last(spark):
    """A chain of edits, each word five times as frequent as the one before."""
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg"]
    rows = [(1, " ".join(w for i, w in enumerate(chain) for _ in range(5 ** (i + 1))), "en", "a", 1)]
    roots = {word: root for word, *_, root in found(spark, rows, False)}
    assert roots == dict.fromkeys(chain, "akjihg")


def test_ties_go_to_the_smallest_word(spark):
    rows = [(1, "balance " * 5 + "valance " * 25 + "ballance " * 25, "en", "a", 1)]
    forms = {word: (form, n) for word, _, _, form, n, _ in found(spark, rows, False)}
    assert forms["balance"] == ("ballance", 25)


def test_tables_of_tasks_are_sent_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TABLE_WORDS", 7)
    rows = corpus(11)
    assert found(spark, rows) == brute(rows, True)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 7), st.sets(st.text("abé", min_size=1, max_size=8), max_size=40))
def test_search_of_a_list(length, words):
    words = sorted(w for w in words if len(w) in (length, length + 1))
    pairs = sorted(spelling.near_pairs([(w, 1) for w in words], length))
    assert pairs == [
        (i, j)
        for i, a in enumerate(words)
        for j, b in enumerate(words)
        if len(a) == length and a != b and one_edit(a, b)
    ]


def test_prefixes_beyond_one_edit_are_skipped():
    """Words behind a prefix that is two edits off are not looked at again."""
    words = sorted(f"zz{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh")
    lcp = spelling.shared_prefixes(words)
    looked = []

    class Watched(list):
        def __getitem__(self, at):
            looked.append(at)
            return super().__getitem__(at)

    found = spelling.near_in_list("abcde", Watched(words), lcp, spelling._next_shorter(lcp))
    assert list(found) == [] and len(looked) < 5
