import random
import re

import numpy as np
import pytest
import xxhash
from corpus_cases import CLASHING, as_tuples, document_rows, documents, prose

from tripmart.llm import simhash
from tripmart.llm.components import connected_components


def brute_fingerprint(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if 0 < len(words) < 3:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance=3):
    """For each place, the smallest place it can reach."""
    group = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= distance and group[j] < group[i]:
                    group[i], changed = group[j], True
    return group


def ranked(prints):
    def rank(x):
        r, s = x, 1
        while s < 64:
            r ^= r >> s
            s *= 2
        return r

    return sorted(set(prints), key=rank)


def near(rng, centre, bits):
    for b in rng.sample(range(64), bits):
        centre ^= 1 << b
    return centre


@pytest.mark.parametrize("seed", range(12))
def test_index_finds_what_all_pairs_find(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = ranked([near(rng, rng.choice(centres), rng.randrange(6)) for _ in range(rng.randrange(2, 200))])
    found, _ = simhash.linked_groups(np.array(prints, dtype=np.uint64))
    assert found.tolist() == brute_groups(prints)


def test_index_prunes_whole_groups(monkeypatch):
    """Far fewer comparisons than pairs, where groups are far apart, and not without the nodes."""
    rng = random.Random(5)
    centres = [rng.getrandbits(40) << 24 for _ in range(60)]
    prints = [rng.choice(centres) | rng.getrandbits(24) for _ in range(4000)]
    prints = np.array(ranked(prints), dtype=np.uint64)
    _, compared = simhash.linked_groups(prints)
    assert 0 < compared < len(prints) ** 2 / 16
    monkeypatch.setattr(
        simhash, "index_levels", lambda p: [(p, np.full(len(p), ~np.uint64(0)))]
    )
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 1 << 30)
    assert simhash.linked_groups(prints)[1] == len(prints) * (len(prints) - 1) // 2


def test_buckets_hold_thousands_and_the_index_spares_pairs(spark):
    """With the parameters of production, on as many fingerprints as a small corpus has."""
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(6000)]
    prints += [near(rng, p, rng.randrange(1, 6)) for p in prints[:300]]
    rows = [(i, "", simhash._signed(p)) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "doc_id long, tie string, print long")
    sizes = [r["count"] for r in simhash._dealt(frame, len(prints)).groupBy("bucket", "inner").count().collect()]
    assert max(sizes) > 1000 and max(sizes) <= simhash.RUN
    assert len(simhash.index_levels(np.zeros(max(sizes), dtype=np.uint64))) >= 3
    found = simhash.searched(frame).collect()
    compared, spared = (sum(r[c] or 0 for r in found) for c in ("compared", "spared"))
    assert compared + spared == sum(n * (n - 1) // 2 for n in sizes)
    assert spared > compared / 2
    expected = brute_groups_fast(prints)
    reached = {simhash._signed(prints[i]) for i in range(len(prints)) if expected[i]}
    linked = {p for r in found if r.a is not None for p in (r.a, r.b)}
    assert linked == reached


def brute_groups_fast(prints):
    """Whether each fingerprint links with another one."""
    values = np.array(prints, dtype=np.uint64)
    return [
        int((np.bitwise_count(values ^ values[i]) <= 3).sum()) > 1 for i in range(len(values))
    ]


@pytest.mark.parametrize(
    ("fingerprints", "bits"), [(0, 0), (1, 0), (4096, 0), (4097, 1), (10**7, 12), (10**12, 16)]
)
def test_buckets_grow_in_number_with_the_fingerprints(fingerprints, bits):
    assert simhash.bucket_bits(fingerprints) == bits


def test_gray_rank(spark):
    gray = [i ^ (i >> 1) for i in range(64)]
    frame = spark.createDataFrame([(g,) for g in gray], "g long")
    ranks = frame.select(simhash.gray_rank(frame.g).alias("r")).collect()
    assert [r.r for r in ranks] == list(range(64))


def test_documents(spark):
    rows = document_rows()
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    group = brute_groups(prints)
    smallest = {}
    for place, (doc_id, *_) in zip(group, rows, strict=True):
        ids = [i for i in (smallest.get(place), doc_id) if i is not None]
        smallest[place] = min(ids, default=None)
    expected = [
        (row[0], f"{p:016x}", smallest[g]) for row, p, g in zip(rows, prints, group, strict=True)
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert any(r.doc_id == 11 and r.component_id in (3, 11) for r in found)


@pytest.mark.parametrize(("run", "large"), [(16, 2), (64, 1024), (4096, 2)])
def test_large_buckets_are_cut_without_loss(spark, monkeypatch, run, large):
    monkeypatch.setattr(simhash, "RUN", run)
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    prints = list({near(rng, centre, rng.randrange(5)) for _ in range(150)})
    prints += [rng.getrandbits(64) for _ in range(150)]
    rows = [(i, "", simhash._signed(p)) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "doc_id long, tie string, print long")
    found = {r.print: r.doc_id for r in simhash.classes(frame).select("print", "keeper.doc_id").collect()}
    assert [found[p] for *_, p in rows] == brute_groups(prints)


def test_components_of_a_long_chain(spark):
    nodes = list(range(60))
    random.Random(3).shuffle(nodes)
    chain = list(zip(nodes, nodes[1:]))
    links = spark.createDataFrame([*chain, chain[0], (200, 201), (7, 7)], "a long, b long")
    found = as_tuples(connected_components(links), "node", "component")
    assert found == sorted([(n, 0) for n in nodes] + [(200, 200), (201, 200)], key=repr)


def test_one_of_each_group_stays(spark):
    rows = document_rows()
    frame = documents(spark, rows)
    kept = simhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    groups = {r.component_id for r in found if r.component_id is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(groups)
    assert ids.count(None) == 1  # the group in which no document has an id
    assert set(CLASHING) <= set(kept.columns)


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.without_near_duplicates(documents(spark, [])).collect() == []


def test_rows_of_one_id_with_different_texts(spark):
    """No distinct text goes, and no near copy stays in its place."""
    texts = [prose(900 + i, 80) for i in range(30)]
    rows = [(5, t, "en", "a", 1) for t in texts]  # one id for all
    rows += [(3, t, "en", "a", 1) for t in texts[:10]]  # copies of some, with a smaller id
    rows += [(5, texts[29], "en", "a", 1)]  # and a repeated row
    found = simhash.without_near_duplicates(documents(spark, rows)).collect()
    expected = [(3, t) for t in texts[:10]] + [(5, t) for t in texts[10:]]
    assert sorted((r.doc_id, r.text) for r in found) == sorted(expected)


def test_a_family_of_near_copies_is_cut_until_it_is_small(spark, monkeypatch):
    """Fingerprints that agree in an outer and an inner block are not one run."""
    monkeypatch.setattr(simhash, "LARGE", 32)
    rng = random.Random(21)
    # 28 bits in common; then pairs at the full distance, in any of the other bits.
    prints = [rng.getrandbits(36) | 0xABCDEF1 << 36 for _ in range(150)]
    for p in prints[:60]:
        for b in rng.sample(range(36), 3):
            p ^= 1 << b
        prints.append(p)
    prints = list(dict.fromkeys(prints))
    frame = spark.createDataFrame(
        [(i, "", simhash._signed(p)) for i, p in enumerate(prints)], "doc_id long, tie string, print long"
    )
    runs = simhash._dealt(frame, len(prints)).groupBy("bucket", "inner").count()
    assert runs.agg({"count": "max"}).first()[0] < len(prints) / 4
    found = {r.print: r.doc_id for r in simhash.classes(frame).select("print", "keeper.doc_id").collect()}
    assert [found[simhash._signed(p)] for p in prints] == brute_groups(prints)
