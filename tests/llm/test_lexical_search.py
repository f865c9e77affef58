"""Shared evaluation of many queries: same rows as scoring every item alone."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import common, lexical_search
from tallyhouse.llm.lexical_search import accumulated, search, shared_plan, terms_of
from tests.conftest import TEST_FOLDER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CHOICE = random.Random(4)
VOCABULARY = [f"t{k}" for k in range(60)] + ["Été", "日本", "mixed🙂case", "A1"]
DOCS = [(k, " ".join(CHOICE.choices(VOCABULARY, k=CHOICE.randint(1, 60)))) for k in range(300)]
AWKWARD = [(1000, None), (1001, ""), (1002, "--- ... \n\t"), (None, "t1 t2 t3"), (None, "t1 t2 t3"), (7, "t1 t2 t3"), (7, "t4"),
           (1003, "t1 " * 50_000), (1004, "É t1_t2\x7ft3"), (1005, "T1 t1")]
ITEMS = [(k, " ".join(CHOICE.choices(VOCABULARY, k=CHOICE.randint(1, 25)))) for k in range(30)]
AWKWARD_ITEMS = [(100, None), (101, ""), (102, "..."), (103, "absent"), (104, "t1 t1 t1 t2"), (None, "t5"), (105, "t5 absent")]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def alone(docs, items, keep=20):
    counts = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in TERM.findall(lower(text)) if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0))
        for rank, (score, unnamed, i) in enumerate(sorted(scores)[:keep], 1):
            out[item, rank, None if unnamed else i, -score] += 1
    return out


def frames(spark, docs, items):
    left = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, term string, score int")
    right = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, doc_id string")
    return left.repartition(5), right


def test_terms():
    for _, text in DOCS[:20] + AWKWARD:
        assert [t.decode() for t in terms_of((text or "").encode())] == TERM.findall(lower(text))


@pytest.mark.parametrize("block_terms", [200_000, 40])
def test_same_as_alone(spark, block_terms):
    docs, items = frames(spark, DOCS + AWKWARD, ITEMS + AWKWARD_ITEMS)
    got = search(spark, docs, items, block_terms=block_terms).collect()
    assert Counter(map(tuple, got)) == alone(DOCS + AWKWARD, ITEMS + AWKWARD_ITEMS)


def test_ties_and_repeated_rows(spark):
    docs = [(k, "same words here") for k in range(100)] + [(5, "same words here")] + [(200 + k, "other") for k in range(150)]
    items = [(1, "same"), (1, "same"), (2, "words other")]
    left, right = frames(spark, docs, items)
    assert Counter(map(tuple, search(spark, left, right).collect())) == alone(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert search(spark, docs.where("false"), items).count() == 0
    assert search(spark, docs, items.where("false")).count() == 0
    assert search(spark, docs.where("false"), items).columns == ["item_id", "rank", "doc_id", "score"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 12), st.integers(1, 3), min_size=1), min_size=1, max_size=12), st.integers(2, 5))
def test_plan_adds_every_term_of_an_item_once(items, bucket):
    items = [Counter(i) for i in items]
    plan = shared_plan(items, bucket)
    term = np.repeat(np.arange(13), 3)
    doc = np.tile(np.arange(3), 13)
    worth = (term + 1) * 10 ** (2 * doc)
    cells = accumulated(plan, doc, term, worth, 3)
    for counts, nodes in zip(items, plan.items):
        assert list(cells[nodes].sum(axis=0)) == [sum((t + 1) * c for t, c in counts.items()) * 100**d for d in range(3)]


def test_plan_shares():
    """Items built from three phrases need far fewer additions together than alone."""
    phrases = [range(0, 10), range(10, 20), range(20, 30)]
    items = [Counter(t for p in chosen for t in phrases[p]) + Counter([100 + k])
             for k, chosen in enumerate([(0, 1), (0, 1, 2), (1, 2), (0, 2), (0, 1), (2,)])]
    plan = shared_plan(items)
    additions = sum(len(s) for s in plan.steps) + sum(len(nodes) - 1 for nodes in plan.items)
    assert plan.n - sum(len(s) for s in plan.steps) == 3 + len(items)  # a leaf a phrase, one for each item's own term
    assert additions < len(items) * 2 + 2


def test_against_sql(spark):
    got = lexical_search.op12(spark, TEST_FOLDER)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{TEST_FOLDER}/{name}.parquet')")
    names = sorted(got.columns)
    expected = con.execute(f"select {', '.join(names)} from ({common.SQL['op12_lexical_search']})").fetchall()
    assert len(expected) > 100 and Counter(map(tuple, got.select(*names).collect())) == Counter(expected)
