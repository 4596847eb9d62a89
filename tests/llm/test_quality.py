from collections import Counter

import pytest
from corpus_cases import document_rows, documents, prose, words_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import quality


def brute(text):
    words = words_of(text)
    n = len(words)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + k
        for i in range(n - 2)
        if windows[words[i], words[i + 1], words[i + 2]] > 1
        for k in range(3)
    }
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, dup, len(covered)


def test_measures(spark):
    rows = document_rows() + [(800, "a b c a b c\n\na b c\n#x|\n#x|", "en", "a", 1)]
    found = quality.judged(documents(spark, rows))
    assert found.count() == len(rows)
    texts = {i: t for i, t, *_ in rows if i is not None}
    for r in found.filter("doc_id is not null").collect():
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute(texts[r.doc_id])
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert not (failed and r.kept)
    assert {r.kept for r in found.filter("doc_id >= 100 and doc_id < 200").collect()} == {True}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14))
def test_repeated_words(words):
    assert quality.repeated_words(words) == brute(" ".join(words))[4]


def test_runs_of_many_words_are_numbered_anew(monkeypatch):
    words = prose(3, 300, 2).split()
    expected = brute(" ".join(words))[4]
    monkeypatch.setattr(quality, "LARGEST_KEY", 1000)
    assert quality.repeated_words(words) == expected > 0


def test_sketches_merge_and_are_accurate(spark):
    """The fence of a geometric series, from parts: its median and its excess up to the level."""
    n = 20_000
    values = [1.0005**i for i in range(n)]
    frame = spark.range(n).select(
        F.lit("repeats").alias("measure"),
        F.pow(F.lit(1.0005), F.col("id")).alias("v"),
        (F.col("id") % 3).alias("part"),
    )
    binned = frame.withColumn("bin", quality.sketch_bin(F.col("v")))
    parts = binned.groupBy("part", "measure", "bin").agg(F.count("*").alias("n"))
    (row,) = quality.sketch_fences(quality.merged(parts, []), []).collect()
    middle, level = values[n // 2 - 1], quality.LEVEL["repeats"]
    inside = values[: int(n * level)]
    excess = sum(max(v - middle, 0) for v in inside) / (n * (level - 0.5))
    expected = middle + quality.LEAST_DISTANCE["repeats"] + quality.SPREADS["repeats"] * excess
    assert row["values"] == n
    assert abs(row.upper / expected - 1) <= quality.ACCURACY * 1.1


def judged_texts(spark, texts):
    rows = [(i, t, lang, source, 1) for i, (t, lang, source) in enumerate(texts)]
    return {r.doc_id: r for r in quality.judged(documents(spark, rows)).collect()}


def with_measure(seed, measure, amount):
    """A text of 200 words with so much of one measure and nothing of the others."""
    words = [f"w{seed * 1000 + i:07d}" for i in range(200)]
    many = round(200 * amount)
    if measure == "word_length":
        words = [w + "x" * round(10 * amount) for w in words]
    if measure == "symbols":
        words = [w + "|" if i < many else w for i, w in enumerate(words)]
    if measure == "repeats":
        half = many // 2
        words[:half] = words[half : 2 * half]
    lines = [" ".join(words[i : i + 2]) for i in range(0, 200, 2)]
    if measure == "dup_lines":  # in one line, so that no window recurs
        lines = [" ".join(words[i : i + 2]) for i in range(0, 200, 2)]
        for i in range(round(100 * amount / 2)):
            lines[2 * i + 1] = lines[2 * i] = words[4 * i]
    return "\n".join(lines)


AMOUNTS = {"word_length": 0.9, "symbols": 0.4, "dup_lines": 0.7, "repeats": 0.45}


@pytest.mark.parametrize("measure", AMOUNTS)
def test_fences_follow_the_source_for_every_measure(spark, measure):
    """What is common in one source is rejected as an outlier of another, by the measure alone."""
    high = AMOUNTS[measure]
    plain = [(with_measure(i, measure, 0.0), "en", "plain") for i in range(120)]
    usual = [(with_measure(200 + i, measure, high * (0.5 + 0.004 * i)), "en", "usual") for i in range(120)]
    lone = [(with_measure(500, measure, high), "en", "plain")]
    found = judged_texts(spark, plain + usual + lone)
    assert not any(r.base_failed for r in found.values())
    assert not found[240].kept
    assert all(found[i].kept for i in range(120))
    assert sum(found[120 + i].kept for i in range(120)) >= 114
    rows = [(i, t, lang, source, 1) for i, (t, lang, source) in enumerate(plain + usual)]
    bounds = quality.fences(quality.document_stats(documents(spark, rows))).collect()
    one, two = sorted(r.fences[f"{measure}_upper"] for r in bounds)
    assert two > 1.2 * one > 0


def test_a_group_of_any_size_pulls_its_fence_by_its_weight(spark):
    """No size at which the fence jumps, and none at which it is the group's own alone."""
    fence = []
    for n in (0, 48, 49, 50, 51, 400):
        rows = [(i, with_measure(i, "symbols", 0.0), "en", "plain", 1) for i in range(400)]
        rows += [(1000 + i, with_measure(500 + i, "symbols", 0.5), "en", "junk", 1) for i in range(n)]
        rows += [(5000, "too short", "en", "junk", 1)]
        stats = quality.document_stats(documents(spark, rows))
        (row,) = quality.fences(stats).filter("source = 'junk'").collect()
        fence.append(row.fences["symbols_upper"])
    assert fence == sorted(fence)
    steps = [b - a for a, b in zip(fence[1:4], fence[2:5])]
    assert max(steps) < 0.02
    assert fence[0] == pytest.approx(quality.LEAST_DISTANCE["symbols"])


def test_a_source_of_junk_alone_does_not_pass_as_it_is(spark):
    junk = [(with_measure(i, "symbols", 0.6), "en", "junk") for i in range(30)]
    plain = [(with_measure(100 + i, "symbols", 0.0), "en", f"s{i % 3}") for i in range(600)]
    found = judged_texts(spark, junk + plain)
    assert not any(found[i].kept for i in range(30))
    assert all(found[30 + i].kept for i in range(600))


def test_no_documents(spark):
    assert quality.judged(documents(spark, [])).collect() == []


@pytest.mark.parametrize("text", [None, "", "\n\n", "# # #"])
def test_single_documents(spark, text):
    (row,) = quality.judged(documents(spark, [(1, text, None, None, None)])).collect()
    assert row.base_failed and not row.kept
