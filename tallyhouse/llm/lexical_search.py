"""Ranked lexical search of many queries at once, sharing what they have in common (op12).

Terms are maximal runs of letters, digits and other characters above ASCII, A-Z lower-cased. A document's score for an
item is a sum over the item's terms, so items that hold the same set of terms hold the same partial sum.
Those sets are mined from the items before any document is read:

* occurrences of terms held by exactly the same items become one leaf;
* among leaves of similar frequency the pair that most items hold becomes a node of its own, again and again, until no
  pair is held by two items. Nodes and leaves form a directed acyclic graph; an item is the few nodes that are left to it.

One pass over the texts writes the counts of the items' terms per document; sums over that table give N, L and df
of all documents. A second pass fills one accumulator per leaf and document, adds them up along the
graph, each node once, however many items use it, and adds an item's nodes. Every task keeps its 20 best documents
of an item; these few rows alone are shuffled, folded in two steps.

Items come in blocks of a bounded number of terms, each block with its own passes over all documents: what travels to
the tasks is bounded by the block, whatever the number of items. A block ends after the item that fills it.

NULL and empty texts have no terms; an item without terms has no result. Every row of the items is an item of its own,
also one without an id or with a repeated one. Documents with equal score and doc_id are equal in the result, so their order is
free; NULL doc_ids rank after others of the same score. Long texts are taken whole. Other columns are ignored. No documents or no
items give an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tallyhouse.llm.common import documents, integer, load, query, stored, typed
from tallyhouse.llm.packing import texts_of

BEST = 20
BLOCK_TERMS = 200_000  # distinct terms of the items of a block, summed over its items
BUCKET = 128  # leaves of similar frequency among which shared pairs are mined
CELLS = 4 << 20  # accumulators a task holds at once
FOLDS = 64  # groups in which the best documents of the tasks are folded first
_NO_ID = np.iinfo(np.int64).max

_IS_TERM = [chr(b).isalnum() if b < 128 else True for b in range(256)]
_TO_TERMS = bytes((b | 32 if 65 <= b <= 90 else b) if _IS_TERM[b] else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


class Plan(NamedTuple):
    """Accumulators 0 to n - 1: leaves first, then nodes, each the sum of two earlier ones."""

    n: int
    filled: dict[int, list[tuple[int, int]]]  # term: the leaves it adds to, and how many times
    steps: list[np.ndarray]  # rows (node, one, other); a step needs only nodes of earlier steps
    items: list[np.ndarray]  # the accumulators that an item adds up


def shared_plan(items: list[Counter], bucket: int = BUCKET) -> Plan:
    """Mine the term sets that items (term: repeats) share."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, counts in enumerate(items):
        for term, repeats in counts.items():
            for k in range(repeats):
                holders[term, k].append(i)
    classes: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for (term, _), held in sorted(holders.items()):
        classes[tuple(held)].append(term)
    filled: dict[int, list[tuple[int, int]]] = defaultdict(list)
    parts: list[set[int]] = [set() for _ in items]
    shared = []
    for leaf, (held, terms) in enumerate(classes.items()):
        for term, repeats in Counter(terms).items():
            filled[term].append((leaf, repeats))
        for i in held:
            parts[i].add(leaf)
        if len(held) > 1:
            shared.append((-len(held), leaf))
    n, level, adds = len(classes), [0] * len(classes), []
    shared.sort()
    # Pairs are sought inside a bucket, so mining takes time in proportion to the length of the items.
    for first in range(0, len(shared), bucket):
        members = {leaf for _, leaf in shared[first : first + bucket]}
        here = [p & members for p in parts]
        for i, own in enumerate(here):
            parts[i] -= own
        at: dict[int, set[int]] = defaultdict(set)
        for i, own in enumerate(here):
            for node in own:
                at[node].add(i)
        count = Counter(pair for own in here for pair in itertools.combinations(sorted(own), 2))
        heap = [(-c, pair) for pair, c in count.items() if c > 1]
        heapq.heapify(heap)
        while heap:
            c, (a, b) = heapq.heappop(heap)
            both = at[a] & at[b]
            if len(both) < 2:
                continue
            if len(both) != -c:  # other pairs have taken some of its items meanwhile
                heapq.heappush(heap, (-len(both), (a, b)))
                continue
            node, n = n, n + 1
            level.append(max(level[a], level[b]) + 1)
            adds.append((level[node], node, a, b))
            near: Counter = Counter()
            for i in both:
                here[i] -= {a, b}
                near.update(here[i])
                here[i].add(node)
            at[a] -= both
            at[b] -= both
            at[node] = both
            for other, c in near.items():
                if c > 1:
                    heapq.heappush(heap, (-c, (other, node)))
        for i, own in enumerate(here):
            parts[i] |= own
    steps = [
        np.array([add[1:] for add in group], dtype=np.int64)
        for _, group in itertools.groupby(sorted(adds), key=lambda add: add[0])
    ]
    return Plan(n, dict(filled), steps, [np.array(sorted(p), dtype=np.int64) for p in parts])


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n_terms, terms, times`` of every document that holds any term: counts of the numbered ones."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # at most a block of terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, sizes, terms, times = [], [], [], []
            for at, text in enumerate(texts_of(batch.column(1))):
                every = terms_of(text)
                if every:
                    held = Counter([known[t] for t in every if t in known])
                    rows.append(at)
                    sizes.append(len(every))
                    terms.append(list(held.keys()))
                    times.append(list(held.values()))
            yield pa.record_batch({
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                "n_terms": pa.array(sizes, pa.int64()),
                "terms": pa.array(terms, pa.list_(pa.int32())),
                "times": pa.array(times, pa.list_(pa.int64())),
            })

    rows = typed(docs, doc_id="long", text="string").mapInArrow(
        count, "doc_id long, n_terms long, terms array<int>, times array<long>"
    )
    return stored(rows, "postings")


class Best:
    """The best documents of every item seen so far."""

    def __init__(self, n_items: int, keep: int):
        self.keep, self.least = keep, np.zeros(n_items, dtype=np.int64)
        self.rows = [np.zeros((0, 3), dtype=np.int64)]  # item, score, doc_id with _NO_ID for NULL
        self.nulls = [np.zeros(0, dtype=bool)]
        self.size = 0

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        hit = np.flatnonzero((scores >= self.least[item]) & (scores > 0))
        if len(hit) > self.keep:  # of one call only what is not worse than its own best
            least = np.partition(scores[hit], len(hit) - self.keep)[len(hit) - self.keep]
            hit = hit[scores[hit] >= least]
        self.rows.append(np.column_stack([np.full(len(hit), item, dtype=np.int64), scores[hit], ids[hit]]))
        self.nulls.append(nulls[hit])
        self.size += len(hit)
        if self.size > 100_000 + 4 * self.keep * len(self.least):
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        rows, nulls = np.concatenate(self.rows), np.concatenate(self.nulls)
        order = np.lexsort((rows[:, 2], nulls, -rows[:, 1], rows[:, 0]))
        rows, nulls = rows[order], nulls[order]
        starts = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - starts
        last = rows[place == self.keep - 1]
        self.least[last[:, 0]] = last[:, 1]
        rows, nulls = rows[place < self.keep], nulls[place < self.keep]
        self.rows, self.nulls, self.size = [rows], [nulls], 0
        return rows, nulls


def accumulated(plan: Plan, doc: np.ndarray, term: np.ndarray, worth: np.ndarray, n_docs: int) -> np.ndarray:
    """One row per accumulator, one column per document."""
    cells = np.zeros((plan.n, n_docs), dtype=np.int64)
    order = np.argsort(term, kind="stable")
    doc, term, worth = doc[order], term[order], worth[order]
    edges = np.flatnonzero(np.diff(term, prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(term)]):
        for leaf, repeats in plan.filled.get(int(term[lo]), ()):
            cells[leaf, doc[lo:hi]] += repeats * worth[lo:hi]  # a document holds a term once here
    for step in plan.steps:
        cells[step[:, 0]] = cells[step[:, 1]] + cells[step[:, 2]]
    return cells


def ranked_block(counts: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, keep: int) -> DataFrame:
    """``item`` (number in the block), ``score, doc_id``: at least the best documents of every item, a few per task."""
    shared = counts.sparkSession.sparkContext.broadcast((plan, weights))  # in proportion to the terms of a block

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        best = Best(len(plan.items), keep)
        width = max(CELLS // max(plan.n, 1), 16)
        for whole in batches:
            for first in range(0, whole.num_rows, width):
                batch = whole.slice(first, width)
                nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
                spread = [75 + 25 * n * n_docs // n_terms for n in batch.column("n_terms").to_pylist()]
                lists = batch.column("terms")
                lengths = lists.value_lengths().to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), lengths)
                term = lists.flatten().to_numpy().astype(np.int64)
                times = batch.column("times").flatten().to_numpy()
                m = np.array(spread, dtype=np.int64)[doc]
                worth = weights[term] * (1_000_000_000 * times // (1000 * times + 12 * m))
                cells = accumulated(plan, doc, term, worth, batch.num_rows)
                for item, nodes in enumerate(plan.items):
                    best.add(item, cells[nodes].sum(axis=0), ids, nulls)
        rows, nulls = best.fold()
        yield pa.record_batch({
            "item": pa.array(rows[:, 0]), "score": pa.array(rows[:, 1]), "doc_id": pa.array(rows[:, 2], mask=nulls),
        })

    return counts.mapInArrow(rank, "item long, score long, doc_id long")


def blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[list[int | None], list[Counter]]]:
    """The items with terms, a block at a time."""
    ids, held, size = [], [], 0
    for item_id, text in typed(items, item_id="long", text="string").toLocalIterator():
        counts = Counter(terms_of((text or "").encode()))
        if not counts:
            continue
        ids.append(item_id)
        held.append(counts)
        size += len(counts)
        if size >= block_terms:
            yield ids, held
            ids, held, size = [], [], 0
    if ids:
        yield ids, held


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, keep: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``keep`` best documents of every item."""
    found = None
    for ids, held in blocks(items, block_terms):
        numbers = {t: k for k, t in enumerate(sorted(set().union(*held)))}
        counts = postings(docs, numbers)
        n_docs, n_terms = counts.count(), integer(counts, F.sum("n_terms"))
        if not n_docs:
            continue
        holding = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weights = np.zeros(len(numbers), dtype=np.int64)
        for term, df in holding.collect():  # one row per term of the block
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        plan = shared_plan([Counter({numbers[t]: c for t, c in counter.items()}) for counter in held])
        best = ranked_block(counts, plan, weights, n_docs, n_terms, keep)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # Every task brings its best: a first fold in groups, then one of the groups' best.
        for group in ([F.col("item"), F.pmod(F.xxhash64("doc_id", "score"), F.lit(FOLDS))], [F.col("item")]):
            best = best.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= keep)
        named = spark.createDataFrame(list(enumerate(ids)), "number long, item_id long")
        part = best.join(F.broadcast(named), F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(table: str, key: str) -> str:
    return f"""select {key}, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{PATTERN}')) as term
        from {table}"""


ORACLE = f"""
with held as ({_terms_sql('documents', 'doc_id')}),
counts as (select doc_id, term, count(*) as tf from held group by all),
sizes as (select doc_id, sum(tf)::bigint as n from counts group by all),
total as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes),
weights as (
    select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
    from counts, total group by term),
wanted as (select item_id, term, count(*) as repeats from ({_terms_sql('benchmark', 'item_id')}) group by all),
scored as (
    select item_id, doc_id,
        sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
    from wanted join weights using (term) join counts using (term) join sizes using (doc_id), total
    group by all)
select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
from scored where score > 0
qualify rank <= {BEST}
"""


@query("op12_lexical_search", ORACLE)
def op12(spark, folder):
    return search(spark, documents(spark, folder), load(spark, folder, "benchmark"))
