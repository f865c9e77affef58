"""Document quality from a linear-chain conditional random field over lines (op4).

Every line is good or bad. A line's evidence is its own features and those of the lines before and
after it; a transition weight ties neighbouring labels. Training maximises the conditional
likelihood of line labels. These start as the document's label; after a first fit, lines of bad
documents that look good become good, if the document keeps a bad line, and the field is fitted again.
Scoring runs forward-backward over all lines of a document; the marginals of its lines, weighted by their length,
give its share of good text, and a logistic curve fitted on the sample turns the share into the score.

The sample is bounded (``PER_CLASS`` documents of each label, a parameter), and in training a chain
ends after ``CHAIN`` lines and a new one begins; scoring uses whole documents. Blank lines carry no
weight and no label of their own. NULL text is an empty text. A text without words has weight 0 everywhere and scores the
logistic curve at a share of 0. Without both labels to learn from the score is the smoothed share of label 1, at least 0.5.
Repeated rows and NULL doc_ids are scored like any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import documents, held_out, load, query, typed
from tallyhouse.llm.packing import lean, texts_of
from tallyhouse.llm.rolling import Words
from tallyhouse.llm.training import fitted_in_task, labelled_sample

PER_CLASS, CHAIN, ROUNDS, PENALTY, BLOCK_BYTES = 1200, 128, 80, 1e-3, 1 << 20


def _classes() -> np.ndarray:
    """A class for every byte: letter, digit, sentence mark, other mark, blank, beyond ASCII."""
    kinds = np.full(256, 3, dtype=np.uint8)
    kinds[128:] = 5
    for chars, kind in ((range(65, 91), 0), (range(97, 123), 0), (range(48, 58), 1), (b".,;:!?'\"()-", 2), (range(0, 33), 4)):
        kinds[list(chars)] = kind
    return kinds


CLASSES = _classes()
N_OWN = 14


def line_features(lines: list[bytes]) -> np.ndarray:
    """Features of each line by itself, about 0 to 1 each."""
    words = Words(lines)
    n = len(lines)
    size = np.array([len(x) for x in lines], dtype=np.int64)
    bounds = np.cumsum(size + 1) - (size + 1)
    out = np.zeros((n, N_OWN), dtype=np.float32)
    if not n:
        return out
    full = np.maximum(size, 1)
    kinds = CLASSES[words.blob]
    for kind in range(6):
        count = np.add.reduceat((kinds == kind).astype(np.int32), bounds)
        out[:, kind] = (count - (kind == 4)) / full  # the line's end counted as a blank
    capitals = np.add.reduceat(((words.blob >= 65) & (words.blob <= 90)).astype(np.int32), bounds)
    out[:, 6] = capitals / full
    counts = words.counts
    some = np.maximum(counts, 1)
    owner = np.repeat(np.arange(n), counts)
    hashes = words.hashes(0)
    same = np.zeros(len(hashes), dtype=np.int32)
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out[:, 7] = np.bincount(owner, weights=same, minlength=n) / some
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)
    out[:, 8] = 1 - distinct / some
    out[:, 9] = np.minimum(size / some, 30) / 30
    out[:, 10] = np.log1p(size) / 8
    out[:, 11] = np.log1p(counts) / 6
    out[:, 12] = counts <= 2
    out[:, 13] = size == 0
    return out


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, in runs of about ``BLOCK_BYTES``; a longer text is alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > BLOCK_BYTES:
            yield texts[at:i]
            at, size = i, 0
        size += len(t)
    if len(texts) > at:
        yield texts[at:]


class Chains:
    """Documents as chains of lines, with own and neighbours' features."""

    @classmethod
    def joined(cls, texts: list[bytes]) -> Chains:
        """The same chains, made block by block: features take many times the room of their texts while they are made."""
        parts, whole = [cls(block) for block in blocks(texts)], cls.__new__(cls)
        whole.lengths, whole.weight, whole.x = (np.concatenate([getattr(p, name) for p in parts]) for name in ("lengths", "weight", "x"))
        return whole

    def __init__(self, texts: list[bytes]):
        split = [t.split(b"\n") for t in texts]
        lines = [x for part in split for x in part]
        self.lengths = np.array([len(part) for part in split], dtype=np.int64)
        self.weight = np.array([len(x.strip()) for x in lines], dtype=np.float64)
        own = line_features(lines)
        first = np.cumsum(self.lengths) - self.lengths
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[first], after[first + self.lengths - 1] = 0, 0
        edge = np.zeros((len(own), 2), dtype=np.float32)
        edge[first, 0], edge[first + self.lengths - 1, 1] = 1, 1
        self.x = np.hstack([own, before, after, edge, np.ones((len(own), 1), dtype=np.float32)])


def marginals(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray):
    """Forward-backward over all chains at once, one position a step, longest chains first.

    ``emission`` is the log-odds of a good line. Returns P(good) of every line, the expected number
    of each pair of neighbouring labels, and the log normaliser of all chains together.
    """
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    half = np.stack([-emission / 2, emission / 2], axis=1)
    alpha, beta = np.empty_like(half), np.zeros_like(half)
    longest = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(longest + 1)]
    for t in range(longest):
        at = first[: active[t]] if t == 0 else first[: active[t]] + t
        if t == 0:
            alpha[at] = half[at]
        else:
            a = alpha[at - 1][:, :, None] + transition
            alpha[at] = np.logaddexp(a[:, 0], a[:, 1]) + half[at]
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        b = transition + (half[at + 1] + beta[at + 1])[:, None, :]
        beta[at] = np.logaddexp(b[:, :, 0], b[:, :, 1])
    total = np.logaddexp(*(alpha + beta).T)
    good = np.exp(alpha[:, 1] + beta[:, 1] - total)
    inner = np.ones(len(emission), dtype=bool)
    inner[first] = False
    to = np.flatnonzero(inner)
    pairs = np.exp(alpha[to - 1][:, :, None] + transition + (half[to] + beta[to])[:, None, :] - total[to][:, None, None])
    return good, pairs.sum(axis=0), float(total[first].sum())


def _adam(slope, start: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    w, first, second = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, rounds + 1):
        g = slope(w)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w


def fit(texts: list[bytes], labels: np.ndarray) -> dict:
    n, positive = len(labels), int(labels.sum())
    if positive in (0, n):
        return {"prior": (positive + 1.5) / (n + 2.5) if positive == n else 0.5}
    chains = Chains.joined(texts)
    whole = chains.lengths
    doc = np.repeat(np.arange(n), whole)
    cut = np.concatenate([np.append(np.full((k - 1) // CHAIN, CHAIN), k - (k - 1) // CHAIN * CHAIN) for k in whole])
    x, k = chains.x.astype(np.float64), chains.x.shape[1]
    first = np.cumsum(cut) - cut
    inner = np.ones(len(x), dtype=bool)
    inner[first] = False
    to = np.flatnonzero(inner)
    # Both labels weigh the same, whatever the sample's shares are.
    share = np.bincount(labels[doc], weights=np.maximum(chains.weight, 1), minlength=2)
    shift = float(np.log(share[1] / share[0]))

    def train(target: np.ndarray, start: np.ndarray) -> np.ndarray:
        seen = np.zeros((2, 2))
        np.add.at(seen, (target[to - 1], target[to]), 1)

        def slope(w):
            good, pairs, _ = marginals(x @ w[:k], cut, w[k:].reshape(2, 2))
            g = np.append(x.T @ (good - target), (pairs - seen).reshape(-1)) / len(x)
            return g + PENALTY * w

        return _adam(slope, start, ROUNDS, 0.1)

    w = train(labels[doc], np.zeros(k + 4))
    good, _, _ = marginals(x @ w[:k], whole, w[k:].reshape(2, 2))
    target = np.where((labels[doc] == 0) & (good >= 0.8), 1, labels[doc])
    lowest = np.full(n, 2.0)
    np.minimum.at(lowest, doc, good)
    none_bad = (labels == 0) & (lowest >= 0.8)
    target[none_bad[doc]] = 0
    w = train(target, w)
    share = _share(chains, w)

    def curve(c):
        p = 1 / (1 + np.exp(-(c[0] * share + c[1])))
        return np.array([((p - labels) * share).mean(), (p - labels).mean()]) + 1e-4 * c

    return {"w": w, "curve": _adam(curve, np.array([4.0, -2.0]), 600, 0.05), "shift": shift}


def _share(chains: Chains, w: np.ndarray) -> np.ndarray:
    k = chains.x.shape[1]
    good, _, _ = marginals((chains.x @ w[:k].astype(np.float32)).astype(np.float64), chains.lengths, w[k:].reshape(2, 2))
    doc = np.repeat(np.arange(len(chains.lengths)), chains.lengths)
    weight = np.bincount(doc, weights=chains.weight, minlength=len(chains.lengths))
    return np.bincount(doc, weights=good * chains.weight, minlength=len(weight)) / np.maximum(weight, 1)


def scores(texts: list[bytes], model: dict) -> np.ndarray:
    if "prior" in model:
        return np.full(len(texts), model["prior"])
    margin = model["curve"][0] * _share(Chains(texts), model["w"]) + model["curve"][1]
    return 1 / (1 + np.exp(-margin))


def fit_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    return fitted_in_task(labelled_sample(docs, labels, "quality", per_class), fit)


def with_score(docs: DataFrame, model: dict, keep: bool = False) -> DataFrame:
    """``doc_id, score`` for every row; with ``keep`` all columns of ``docs`` and the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scores(block, model) for block in blocks(texts_of(batch.column(1)))]
            done = np.concatenate(found) if found else np.zeros(0)
            columns = dict(zip(batch.schema.names[: 2 if keep else 1], batch.columns)) | dict(zip(batch.schema.names[2:], batch.columns[2:]))
            yield pa.record_batch(columns | {"score": pa.array(done, pa.float64())})

    if not keep:
        return typed(docs, doc_id="long", text="string").mapInArrow(lean(run), "doc_id long, score double")
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "score")]
    rows = docs.select("doc_id", "text", *rest)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(lean(run), f"{kinds}, score double")


@query("op4_line_quality")
def op4(spark, folder):
    docs = documents(spark, folder)
    scored = with_score(docs, fit_sample(docs, load(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
