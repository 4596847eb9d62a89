"""Toxicity: a character n-gram linear classifier on naive Bayes features.

A text is the bag of its character n-grams, hashed into a fixed number of columns. The
feature of a column is its log-count ratio, which is how much more often toxic texts have
the n-gram than others, times a damped count: one occurrence says little, several say more.
A regularised logistic regression weighs the features. Ratios and weights are learned from
labelled documents, at most ``SAMPLE`` of each class. Scores of labelled documents that a
fold of the sample has not seen set the scale of the final probability.

The sample goes to one task, bounded by that parameter. Scoring reads every text once; the
tasks get the weights with their function, ``COLUMNS`` numbers whatever the corpus.

Defined results: a text too short for an n-gram, or no text, has the score of an empty bag.
Without labels of both classes nothing can be learned: every score is 0. A document whose
labels disagree counts as toxic; of rows repeated with one id the smallest text is learned
from. Labels without an id or a class are left out. Other columns are not read, or kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_rows, rows_in_arrow

# Parameters: documents of each class to learn from, n-gram lengths, columns.
SAMPLE = 2500
LENGTHS = (3, 4, 5)
COLUMN_BITS = 18
COLUMNS = 1 << COLUMN_BITS

# Parameters of the fit: columns that at least so many sampled documents have, and whose
# ratio is at least so far from none; weight of the penalty; steps; folds for the scale.
LEAST_DOCUMENTS = 3
LEAST_RATIO = 0.7
PENALTY = 0.01
STEPS = 80
STEP = 0.02
FOLDS = 3
MOST_COUNTED = 4  # of an n-gram in one document, for its ratio
FIRST = 0.2  # what the first occurrence counts; more add their logarithm

THRESHOLD = 0.7
HELD_OUT = (3, 1)  # documents whose hash has this remainder are never learned from

_MODEL = pa.schema([("weights", pa.binary()), ("bias", pa.float64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def held_out(doc_id: Column) -> Column:
    modulus, remainder = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


# -- Features ---------------------------------------------------------------------------


def gram_columns(text: str | None) -> list[np.ndarray]:
    """The columns of the n-grams at every place, one array per length."""
    folded = f" {' '.join((text or '').lower().split())} "
    points = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    hashes = np.zeros(len(points), dtype=np.uint32)
    found = []
    for n in range(1, max(LENGTHS) + 1):
        here = len(points) - n + 1
        if here <= 0:
            break
        hashes = hashes[:here] * np.uint32(0x01000193) + points[n - 1 :]
        if n in LENGTHS:
            mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            found.append(mixed >> np.uint32(32 - COLUMN_BITS))
    return found


def bag(text: str | None, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a text and their counts; only those marked in ``kept``."""
    found = gram_columns(text)
    if kept is not None:
        found = [columns[kept[columns]] for columns in found]
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def damped(counts: np.ndarray) -> np.ndarray:
    return FIRST + np.log(counts)


# -- Learning ---------------------------------------------------------------------------


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def _fit(columns, values, rows, toxic, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression, both classes weighing the same.

    Entries are given as three parallel arrays; steps are scaled by running moments of
    the gradient.
    """
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    width = int(columns.max()) + 1 if len(columns) else 1
    weights, bias = np.zeros(width), 0.0
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights[columns] * values, len(toxic)) + bias
        error = (_sigmoid(z) - toxic) * share
        slope = np.bincount(columns, error[rows] * values, width) + penalty * weights
        gradient = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = STEP * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def _model(bags: list, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each column's damped count, and the bias."""
    in_class = np.zeros((2, COLUMNS))
    seen = np.zeros(COLUMNS, dtype=np.int64)
    for (columns, counts), one in zip(bags, toxic.astype(int), strict=True):
        in_class[one, columns] += np.minimum(counts, MOST_COUNTED)
        seen[columns] += 1
    ratio = np.log((in_class[1] + 1) / (toxic.sum() + 2)) - np.log(
        (in_class[0] + 1) / ((~toxic).sum() + 2)
    )
    kept = (seen >= LEAST_DOCUMENTS) & (np.abs(ratio) >= LEAST_RATIO)
    # Only kept columns go to the fit, numbered anew.
    number = np.cumsum(kept) - 1
    used = [kept[columns] for columns, _ in bags]
    rows = np.repeat(np.arange(len(bags)), [int(u.sum()) for u in used])
    columns = np.concatenate([c[u] for (c, _), u in zip(bags, used, strict=True)])
    counts = np.concatenate([n[u] for (_, n), u in zip(bags, used, strict=True)])
    values = damped(counts.astype(np.float64)) * ratio[columns]
    fitted, bias = _fit(number[columns], values, rows, toxic, PENALTY)
    weights = np.zeros(COLUMNS)
    weights[np.flatnonzero(kept)[: len(fitted)]] = fitted[: kept.sum()]
    return weights * ratio, bias


def _total(weights: np.ndarray, bias: float, entry: tuple) -> float:
    columns, counts = entry
    return float((weights[columns] * damped(counts.astype(np.float64))).sum() + bias)


def learn(rows: Iterable[tuple[str | None, int]]) -> tuple[np.ndarray, float]:
    """Weights of the damped counts, and bias, scaled so that the logistic function of the
    sum is a probability under equal class shares.

    Of each text and its label only the bag is kept: ``COLUMNS`` entries at most.
    """
    # Counts are damped, so that they need not be exact beyond the smaller type.
    most = np.iinfo(np.uint16).max
    bags, labels = [], []
    for text, label in rows:
        columns, counts = bag(text)
        bags.append((columns, np.minimum(counts, most).astype(np.uint16)))
        labels.append(label)
    toxic = np.array(labels, dtype=bool)
    if toxic.all() or not toxic.any():
        return np.zeros(COLUMNS, dtype=np.float32), -np.inf
    weights, bias = _model(bags, toxic)
    # Rows come in the order of a hash, so every fold gets its share of both classes.
    place = np.zeros(len(bags), dtype=int)
    for one in (toxic, ~toxic):
        place[one] = np.arange(one.sum()) % FOLDS
    totals = np.zeros(len(bags))
    for fold in range(FOLDS):
        rest = place != fold
        if toxic[rest].all() or not toxic[rest].any():
            return weights.astype(np.float32), bias
        other = _model([b for b, r in zip(bags, rest, strict=True) if r], toxic[rest])
        for i in np.flatnonzero(~rest):
            totals[i] = _total(*other, bags[i])
    one = np.arange(len(bags))
    scale, shift = _fit(np.zeros(len(bags), dtype=int), totals, one, toxic, 0.0)
    if scale[0] <= 0:  # the folds learned nothing
        return weights.astype(np.float32), bias
    return (weights * scale[0]).astype(np.float32), bias * scale[0] + shift


def train(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE
) -> tuple[np.ndarray, float]:
    """Learn from at most ``sample`` documents of each class, those with the smallest hash."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    chosen = known.filter("toxic = 1").orderBy("place", "doc_id").limit(sample).unionAll(
        known.filter("toxic = 0").orderBy("place", "doc_id").limit(sample)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # two samples of rows at most
        .groupBy("doc_id", "toxic", "place")
        .agg(F.min("text").alias("text"))
        .repartition(1)
        .sortWithinPartitions("place", "doc_id")
        .select("toxic", "text")
    )

    def fit(rows: Iterator[dict]) -> Iterator[tuple]:
        weights, bias = learn((row["text"], row["toxic"]) for row in rows)
        yield weights.tobytes(), bias

    found = rows.mapInArrow(rows_in_arrow(fit, _MODEL), "weights binary, bias double").collect()
    if not found:
        return np.zeros(COLUMNS, dtype=np.float32), -np.inf
    return np.frombuffer(found[0]["weights"], dtype=np.float32), found[0]["bias"]


# -- Scoring ----------------------------------------------------------------------------


def score_text(text: str | None, weights: np.ndarray, bias: float, kept: np.ndarray) -> float:
    return float(_sigmoid(_total(weights, bias, bag(text, kept)))) if np.isfinite(bias) else 0.0


def scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, score."""
    weights, bias = train(documents, labels, sample)

    def score(rows: Iterator[dict]) -> Iterator[tuple]:
        kept = weights != 0
        for row in rows:
            yield row["doc_id"], score_text(row["text"], weights, bias, kept)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(rows_in_arrow(score, _SCORES), "doc_id long, score double")


def without_toxic(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """The documents with a score below the threshold, with their own columns.

    No text is moved: it is scored where it is read.
    """
    weights, bias = train(documents, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        kept = weights != 0
        return pd.Series([score_text(text, weights, bias, kept) for text in texts], dtype=float)

    rows = documents.select(as_rows(documents), score("text").alias("score"))
    return rows.filter(F.col("score") < threshold).select("row.*")
