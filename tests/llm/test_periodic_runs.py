import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from corpus_cases import document_rows, documents, prose, words_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import periodic_runs as module
from tripmart.llm import queries


def brute_runs(words, least=24):
    """Every stretch of words that keep a period, for every period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        start = 0
        while start < len(words) - q:
            end = start
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, 3 * q):
                found.setdefault((start, length), q)
            start = end + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def brute_planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def periodic_rows():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        period = prose(i, rng.randrange(1, 30), 50)
        inner = (period + " ") * rng.randrange(2, 12)
        words = (prose(100 + i, rng.randrange(40), 9) + " " + inner + prose(200 + i, 20, 9)).split()
        words = words[: len(words) - rng.randrange(len(words) // 2)]
        rows.append((3000 + i, "\n ".join(words), "en", "a", 1))
    return rows


def test_runs_of_documents(spark):
    rows = document_rows() + periodic_rows()
    found = module.periodic_runs(documents(spark, rows)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        words = words_of(text)
        runs = brute_runs(words)
        kept = " ".join(brute_kept(words, runs))
        expected.append((doc_id, len(words), runs, kept, hashlib.sha256(kept.encode()).hexdigest()))
    ours = [
        (r.doc_id, r.n_words, list(zip(r.start, r.length, r.period)), r.collapsed, r.collapsed_sha256)
        for r in found
    ]
    assert sorted(ours, key=repr) == sorted(expected, key=repr)
    assert sum(bool(runs) for _, _, runs, *_ in expected) > 20
    assert module.periodic_runs(documents(spark, [])).collect() == []


def test_query_on_planted_runs(spark, tmp_path):
    rows = [r[:5] for r in document_rows() + periodic_rows()]
    rows += [(5000 + i, prose(i, 90), "en", "a", 1) for i in range(60)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text, *_ in rows:
        words = brute_planted(doc_id, words_of(text))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(brute_kept(words, runs))
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
        expected.append((doc_id, len(runs), *best, milli, *hashes))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    ]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


words = st.one_of(
    st.lists(st.integers(0, 2), max_size=90),
    st.builds(
        lambda head, unit, times, tail: head + unit * times + tail,
        st.lists(st.integers(0, 3), max_size=20),
        st.lists(st.integers(0, 3), min_size=1, max_size=17),
        st.integers(1, 9),
        st.lists(st.integers(0, 3), max_size=20),
    ),
)


@settings(max_examples=400, deadline=None)
@given(words)
def test_runs_of_any_words(words):
    assert module.runs_of(words) == brute_runs(words)


@pytest.mark.parametrize("least", [3, 6])
def test_short_runs(monkeypatch, least):
    """The least length is no part of the method."""
    monkeypatch.setattr(module, "LEAST", least)
    rng = random.Random(least)
    for _ in range(500):
        words = [rng.randrange(2) for _ in range(rng.randrange(60))]
        assert module.runs_of(words) == brute_runs(words, least)


def test_a_text_of_one_word_is_one_proposal():
    ids = module.np.zeros(20_000, dtype=module.np.int64)
    for level, (_, following) in enumerate(module.basic_factors(ids, 6666)):
        places, _ = module._proposed(following, 1 << level)
        assert places.tolist() == ([0] if level == 0 else [])
    assert module.runs_of(["same"] * 20_000) == [(0, 20_000, 1)]


def test_ties_go_to_the_first_run():
    runs = [(0, 48, 2), (60, 24, 1), (90, 30, 1), (200, 60, 2)]
    assert module.strongest(runs) == 2
    assert module.strongest([]) is None
