"""Toxicity scores from a linear classifier on scaled character n-grams (op9).

Features are the byte n-grams of the lower-cased text, hashed; each present n-gram counts once and
is scaled by its naive Bayes log-count ratio on the labelled sample, and a logistic regression is
fitted on the scaled features. N-grams seen in fewer than ``MIN_DOCS`` sampled documents, or about
as often in both classes, have no part. The sample is bounded (``PER_CLASS`` documents of each
label, a parameter); every document is scored on its whole text.

NULL or empty text scores the fitted intercept, and so does a text without a known n-gram. Without
both labels to learn from the score is the smoothed share of label 1, below 0.5. Repeated rows and
NULL doc_ids are scored like any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import documents, held_out, load, query, typed
from tallyhouse.llm.packing import texts_of
from tallyhouse.llm.training import labelled_sample

ORDERS, BUCKET_BITS, PER_CLASS, MIN_DOCS, MIN_RATIO = (4, 5, 6), 20, 1500, 4, 1.5
ROUNDS, PENALTY, BLOCK = 150, 1e-2, 1 << 20


def _lowered(text: bytes) -> np.ndarray:
    """The text's lower-cased bytes with a blank at both ends."""
    return np.frombuffer(b" " + text.decode("utf-8", "replace").lower().encode() + b" ", dtype=np.uint8)


def _buckets(values: np.ndarray, order: int) -> np.ndarray:
    n = max(len(values) - order + 1, 0)
    total = np.full(n, order, dtype=np.uint32)
    for k in range(order):
        total = total * np.uint32(0x01000193) + values[k : k + n]
    total ^= total >> np.uint32(15)
    return (total * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS)


def features(text: bytes, known: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of the text; with ``known`` only those flagged there."""
    values, found = _lowered(text), []
    longest = max(ORDERS)
    for at in range(0, max(len(values) - min(ORDERS) + 1, 1), BLOCK):
        block = values[at : at + BLOCK + longest - 1]
        for order in ORDERS:
            buckets = _buckets(block[: BLOCK + order - 1], order)
            found.append(np.unique(buckets if known is None else buckets[known[buckets]]))
    return np.unique(np.concatenate(found))


def fit(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """A weight for every bucket, and the intercept."""
    size = 1 << BUCKET_BITS
    weights = np.zeros(size, dtype=np.float32)
    n, positive = len(labels), int(labels.sum())
    if positive in (0, n):
        return weights, float(np.log((positive + 0.5) / (n - positive + 1.5)) if n == positive == 0 or not positive else -1e-9)
    rows = [features(t).astype(np.int32) for t in texts]
    lengths = np.array([len(r) for r in rows])
    column, row = np.concatenate(rows), np.repeat(np.arange(n), lengths)
    del rows
    hits = [np.bincount(column[labels[row] == k], minlength=size) for k in (0, 1)]
    shares = [(h + 1.0) / (t + 2.0) for h, t in zip(hits, (n - positive, positive))]
    ratio = np.log(shares[1] / shares[0])
    known = (hits[0] + hits[1] >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)
    inside = known[column]
    column, row = column[inside], row[inside]
    ids = np.cumsum(known) - 1
    column, scale = ids[column], ratio[known][ids[column]]
    m = int(known.sum())
    balance = np.where(labels == 1, n / (2 * positive), n / (2 * (n - positive)))
    w, b, first, second = np.zeros(m), 0.0, np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, ROUNDS + 1):  # full-batch Adam on the balanced log loss
        margin = np.bincount(row, weights=w[column] * scale, minlength=n) + b
        wrong = balance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n
        slope = np.append(np.bincount(column, weights=wrong[row] * scale, minlength=m) + PENALTY * w, wrong.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        change = 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        w, b = w - change[:-1], b - change[-1]
    weights[known] = w * ratio[known]
    return weights, float(b)


def fit_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    sample = labelled_sample(docs, labels, "toxic", per_class).toPandas()
    sample["data"] = [t.encode() for t in sample["text"]]
    sample = sample.sort_values(["data", "label"])
    return fit(list(sample["data"]), sample["label"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` for every row."""
    # The weights are 2**BUCKET_BITS numbers whatever the corpus is.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        known = weights != 0
        for batch in batches:
            margins = [
                float(weights[features(t, known)].sum(dtype=np.float64)) + intercept
                for t in texts_of(batch.column(1))
            ]
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins), -30, 30)))
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(scores, pa.float64())})

    return typed(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")


@query("op9_toxicity")
def op9(spark, folder):
    docs = documents(spark, folder)
    scored = score(docs, fit_sample(docs, load(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
