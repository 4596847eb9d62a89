import random
import zlib

import numpy as np
import pytest
from corpus_cases import document_rows, documents, prose
from pyspark.sql import functions as F

from tripmart.llm import toxicity

BAD = ("grobble", "snarfzit", "vexmurk")


def rows_and_labels(n=300):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = prose(1000 + i, 80).split()
        if toxic:
            for _ in range(5):
                words[rng.randrange(80)] = rng.choice(BAD)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr(
        "*", "'x' as place", "'x' as text"
    )


@pytest.fixture(scope="module")
def cases():
    return rows_and_labels()


def scores(spark, rows, labels):
    found = toxicity.scores(documents(spark, rows), label_frame(spark, labels)).collect()
    return {r.doc_id: r.score for r in found}


def test_held_out_documents_are_told_apart(spark, cases):
    rows, labels = cases
    found = scores(spark, rows, labels)
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    predicted = {i for i in held if found[i] >= toxicity.THRESHOLD}
    toxic = {i for i, _, t in labels if t} & set(held)
    assert len(predicted & toxic) >= 0.9 * len(toxic)
    assert len(predicted - toxic) <= 0.02 * len(held)


def test_held_out_labels_are_not_learned_from(spark, cases):
    rows, labels = cases
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    others = [(i, t, "xx", f"s{i}", None) for i, t, *_ in rows]  # language and source as well
    assert scores(spark, rows, labels) == scores(spark, others, turned)
    flags = spark.range(300).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert {r.id for r in flags if r.h} == held


def test_messy_documents(spark, cases):
    rows, labels = cases
    messy = [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in document_rows()]
    odd = [(10_003, None, 1), (None, 1, 1), (0, 0, 0), (5, 1, None)]
    found = toxicity.scores(
        documents(spark, rows + messy), label_frame(spark, labels + odd)
    ).collect()
    assert len(found) == len(rows) + len(messy)
    assert all(0.0 <= r.score <= 1.0 for r in found)
    assert len({r.score for r in found if r.doc_id in (10_021, 10_022, 10_023)}) == 1


def test_toxic_documents_go(spark, cases):
    rows, labels = cases
    messy = [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in document_rows()]
    frame = documents(spark, rows + messy)
    kept = toxicity.without_toxic(frame, label_frame(spark, labels))
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    toxic = {i for i, _, t in labels if t}
    assert len(toxic & set(ids)) <= 0.1 * len(toxic)
    assert len([i for i in ids if i not in toxic]) >= 0.98 * (len(rows) + len(messy) - len(toxic))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 1, 1)], [(100, 1, 0)]])
def test_one_class_teaches_nothing(spark, labels):
    found = scores(spark, document_rows(), labels)
    assert set(found.values()) == {0.0}


def test_no_documents(spark):
    assert scores(spark, [], [(1, 1, 1)]) == {}


def test_bags():
    columns, counts = toxicity.bag("Ab\n ab")
    again, _ = toxicity.bag(" aB \t AB ")
    assert (columns == again).all() and counts.max() >= 2
    kept = np.zeros(toxicity.COLUMNS, dtype=bool)
    kept[columns[0]] = True
    assert toxicity.bag("ab ab", kept)[0].tolist() == [columns[0]]
