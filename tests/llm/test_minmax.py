import random
import re

import numpy as np
import pytest
from corpus_cases import document_rows, documents, prose

from tripmart.llm import minmax

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_set(text):
    words = [w for w in SPACE.split((text or "").translate(LOWER)) if w]
    if len(words) < 2:
        return frozenset(words)
    return frozenset(f"{a} {b}" for a, b in zip(words, words[1:]))


def brute(rows):
    """Over all pairs of documents."""
    sets = [brute_set(text) for _, text, *_ in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    smallest = {}
    for place, (doc_id, *_) in zip(group, rows, strict=True):
        ids = [i for i in (smallest.get(place), doc_id) if i is not None]
        smallest[place] = min(ids, default=None)
    return sorted(
        (
            (row[0], len(s), smallest[g], row[0] == smallest[g])
            for row, s, g in zip(rows, sets, group, strict=True)
        ),
        key=repr,
    )


def found(spark, rows, *options):
    frame = minmax.near_duplicates(documents(spark, rows), *options)
    return sorted(map(tuple, frame.collect()), key=repr)


def changed(rng, text, words):
    parts = text.split()
    for at in rng.sample(range(len(parts)), words):
        parts[at] = f"new{rng.randrange(10**6)}"
    return " ".join(parts)


def family(seed, n, words, most):
    """Near copies of one text, around the least similarity for some of the pairs."""
    rng = random.Random(seed)
    base = prose(seed, words, 5000)
    return [
        (1000 * seed + i, changed(rng, base, rng.randrange(most + 1)), "en", "a", 1)
        for i in rng.sample(range(900), n)
    ]


def test_messy_documents(spark):
    rows = document_rows()
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_families_of_near_copies(spark):
    rows = family(3, 60, 200, 12) + family(4, 40, 60, 9) + family(5, 5, 700, 3) + document_rows()
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [2, 512])
def test_strays_are_compared_in_blocks_without_loss(spark, monkeypatch, block):
    """Bands of few rows make buckets of unlike classes, in which the lead is not enough."""
    monkeypatch.setattr(minmax, "BLOCK", block)
    rng = random.Random(8)
    shared = prose(77, 40, 5000)
    rows = [(i, shared + " " + prose(100 + i, 15 + i % 9, 300), "en", "a", 1) for i in range(30)]
    rows += [(100 + i, changed(rng, rows[i][1], 2), "en", "b", 1) for i in range(0, 30, 2)]
    assert found(spark, rows, 4) == brute(rows)


@pytest.mark.parametrize("columns", [3, 8192])
def test_shared_counts(monkeypatch, columns):
    monkeypatch.setattr(minmax, "_COLUMNS", columns)
    rng = random.Random(columns)
    one, two = (
        [np.array(sorted(rng.sample(range(40), rng.randrange(1, 20)))) for _ in range(n)]
        for n in (5, 7)
    )
    counts = minmax.shared_counts(one, two)
    assert counts.tolist() == [[len(set(a) & set(b)) for b in two] for a in one]
    assert minmax.shared_counts([np.array([1])], [np.array([2])]).tolist() == [[0]]


def test_a_block_gives_a_link_per_component():
    """And not all of its pairs."""
    sets = [np.arange(100) + i for i in range(6)]
    others = [(i, label, s) for i, (label, s) in enumerate(zip([7, 7, 7, 8, 8, 9], sets))]
    assert list(minmax.block_links([(50, 9, sets[0])], others)) == [(50, 0), (50, 3)]
    assert list(minmax.block_links([(50, 9, np.arange(300, 400))], others)) == []


def test_links_that_the_first_of_a_bucket_does_not_show(spark):
    """A chain: each text links with the next ones, and the ends with the middle alone."""
    parts = prose(5, 400, 5000).split()
    rows = [(50 - i, " ".join(parts[8 * i : 8 * i + 200]), "en", "a", 1) for i in range(20)]
    assert found(spark, rows) == brute(rows)
    assert {r[2] for r in found(spark, rows)} == {31}


def test_signatures_estimate_the_similarity():
    """Either value of a permutation agrees as often as the sets are similar, and both
    together vary less than twice as many independent ones would."""
    rng = np.random.default_rng(1)
    shares = []
    for _ in range(300):
        words = rng.integers(0, 1 << 63, 36, dtype=np.uint64)
        one, two = np.unique(words[:30]), np.unique(words[6:])
        (low1, high1), (low2, high2) = minmax.min_max(one), minmax.min_max(two)
        shares.append((np.mean(low1 == low2), np.mean(high1 == high2)))
    low, high = np.array(shares).T
    assert low.mean() == pytest.approx(24 / 36, abs=0.02)
    assert high.mean() == pytest.approx(24 / 36, abs=0.02)
    assert np.corrcoef(low, high)[0, 1] < 0.1


def test_half_as_many_evaluations_as_values():
    keys = minmax.band_keys(minmax.shingle_set(prose(1, 50)))
    assert len(keys) == minmax.BANDS == 2 * minmax.PERMUTATIONS // minmax.ROWS
    assert len(minmax.band_keys(minmax.shingle_set(None))) == 0


def test_links_come_from_bands(spark):
    """Where bands are too long to agree, only equal sets are found."""
    rows = family(3, 20, 200, 12)
    expected = brute(rows)
    assert len({r[2] for r in found(spark, rows, minmax.PERMUTATIONS)}) > len({r[2] for r in expected})
