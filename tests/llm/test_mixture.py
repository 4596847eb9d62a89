import random

from corpus_cases import as_tuples, document_rows, documents, prose, words_of

from tripmart.llm import mixture


def targets(sizes, weights=(3, 1, 2), most=2):
    """Share, cap, and share what is above again, until none is."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, still, out = 1.5 * sum(sizes.values()), set(names), {}
    while still:
        total = sum(weight[s] for s in still)
        over = {s for s in still if weight[s] * left / total >= most * sizes[s]}
        if not over:
            return out | {s: weight[s] * left / total for s in still}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        still -= over
    return out


def check(rows, found):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    wanted = targets(sizes)
    by_source = {}
    for r in found:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - wanted[r.source]) < 1e-6
        assert r.size == 0 or r.copies in (0, 1, 2)
        by_source.setdefault(r.source, []).append(r)
    for source, group in by_source.items():
        taken = sum(r.size * r.copies for r in group)
        largest = max(r.size for r in group)
        assert abs(taken - wanted[source]) <= largest, source
    return by_source


def marked(spark, rows):
    frame = documents(spark, rows)
    found = mixture.with_copies(frame, mixture.mixture_plan(frame))
    return found.select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()


def test_messy_documents(spark):
    rows = document_rows()
    found = marked(spark, rows)
    assert len(found) == len(rows)
    by_source = check(rows, found)
    assert {r.copies for r in found if r.doc_id == 3} in ({0}, {1}, {2})
    assert set(by_source) == {"a", "b", "c", "d", None}


def test_many_documents_and_reruns(spark):
    rng = random.Random(4)
    rows = [
        (i, prose(i % 50, rng.randrange(1, 90)), "en", rng.choice(["hot"] * 8 + ["x", "y", None]), 1)
        for i in range(1500)
    ]
    found = marked(spark, rows)
    check(rows, found)
    again = documents(spark, rows).repartition(7)
    second = mixture.with_copies(again, mixture.mixture_plan(again))
    assert as_tuples(second, "row.doc_id", "copies") == sorted(
        ((r.doc_id, r.copies) for r in found), key=repr
    )


def test_sample_follows_the_pareto_order(spark):
    """Within a source, the documents of the smallest ratio of odds are in, and those with a
    chance of 1 before all others. The order of the random numbers alone is another one."""
    sizes = {i: 1 + i % 7 for i in range(400)} | {401: 60, 402: 200}
    rows = [(i, "w " * n, "en", "abbbc"[i % 5], 1) for i, n in sizes.items()]
    frame = documents(spark, rows)
    found = mixture.with_copies(frame, mixture.mixture_plan(frame))
    drawn = found.select(
        "row.doc_id",
        "row.source",
        "size",
        "target",
        "source_size",
        "copies",
        mixture.uniform(mixture.draw(found.row.doc_id, mixture.F.md5("row.text"))).alias("u"),
    ).collect()
    certain = mixed = quotas = 0
    for source in "abc":
        group = [r for r in drawn if r.source == source]
        whole = int(group[0].target // group[0].source_size)
        quota = group[0].target - whole * group[0].source_size
        if not quota:
            continue
        quotas += 1
        inside = set()
        while True:  # what is above a chance of 1 is in, one after the other
            left = [r for r in group if r.doc_id not in inside]
            rest = quota - sum(r.size for r in group if r.doc_id in inside)
            scale = rest / sum(r.size**2 for r in left)
            sure = {r.doc_id for r in left if scale * r.size >= 1}
            if not sure:
                break
            inside.add(max(sure, key=lambda i: sizes[i]))
        certain += len(inside)
        assert all(r.copies == whole + 1 for r in group if r.doc_id in inside)

        def odds(r, scale=scale):
            return (r.u / (1 - r.u)) / (scale * r.size / (1 - scale * r.size))

        copies = [r.copies for r in sorted(left, key=odds)]
        assert copies == sorted(copies, reverse=True)
        by_chance = [r.copies for r in sorted(left, key=lambda r: r.u)]
        mixed += by_chance != sorted(by_chance, reverse=True)
    assert certain and mixed == quotas > 0


def test_chances_go_by_size(spark):
    """Documents four times as long are in four times as often."""
    rows = [(i, "w " * (40 if i % 3 == 0 else 10), "en", "abbbc"[i % 5], 1) for i in range(6000)]
    found = [r for r in marked(spark, rows) if r.target % r.source_size]
    judged = 0
    for source in {r.source for r in found}:
        shares = {}
        for size in (10, 40):
            copies = [r.copies - int(r.target // r.source_size) for r in found if (r.source, r.size) == (source, size)]
            shares[size] = sum(copies) / len(copies)
        quota = next(r.target % r.source_size / r.source_size for r in found if r.source == source)
        if quota < 0.6:  # no chance reaches 1
            judged += 1
            assert 3.3 < shares[40] / shares[10] < 4.8
    assert judged


def test_the_mix_repeats_whole_documents(spark):
    rows = document_rows()
    frame = documents(spark, rows)
    mixed = mixture.mix(frame)
    assert mixed.columns == frame.columns
    copies = sum(r.copies for r in marked(spark, rows) if r.size)
    assert mixed.count() == copies


def test_no_documents_and_no_words(spark):
    assert marked(spark, []) == []
    found = marked(spark, [(1, None, None, None, None), (2, "", "x", "y", 1)])
    assert sorted((r.size, r.source_size, r.target) for r in found) == [(0, 0, 0.0)] * 2
    assert mixture.mix(documents(spark, [(1, None, None, None, None)])).count() == 0
