"""Spelling variants against brute force and SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import common, spelling
from tallyhouse.llm.spelling import lists, near_pairs, rooted, scan, variants, vocabulary
from tests.conftest import TEST_FOLDER

LETTERS = "aabé×"


def edited(a, b):
    """Exactly one insertion, deletion or replacement."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1 :]


def brute(counts, times=10):
    near = {w: [o for o in counts if edited(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= times * counts[w]:
            form[w] = best
    out = Counter()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))] += 1
    return out


def random_words(seed, count, low, high, letters=LETTERS):
    choice = random.Random(seed)
    return sorted({"".join(choice.choices(letters, k=choice.randint(low, high))) for _ in range(count)})


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text(LETTERS, min_size=1, max_size=9), min_size=1, max_size=40))
def test_scan_finds_every_pair_of_its_length(words):
    words = sorted(words, key=lambda w: w.encode())
    for m in {len(w) for w in words}:
        here = [w for w in words if len(w) in (m, m + 1)]
        one, other = scan(np.zeros(len(here), dtype=np.int64), pa.array(here, pa.string()), np.full(len(here), m))
        got = Counter(frozenset((here[a], here[b])) for a, b in zip(one, other))
        assert got == Counter({
            frozenset((a, b)): 1 for a in here for b in here if edited(a, b) and min(len(a), len(b)) == m
        })


def test_scan_keeps_lists_apart(monkeypatch):
    monkeypatch.setattr(spelling, "PAIRS", 3)  # many small turns
    words, group = ["abc", "abd", "abd", "abe", "xbe"], np.array([1, 1, 2, 2, 2])
    one, other = scan(group, pa.array(words), np.full(5, 3))
    assert sorted(zip(one.tolist(), other.tolist())) == [(0, 1), (2, 3), (3, 4)]


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_every_pair_is_found_once_however_lists_are_cut(spark, most):
    words = random_words(1, 900, 1, 9) + ["long" * 3000, "long" * 3000 + "x", "solitary"]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(4)
    got: Counter = Counter()
    for keyed in lists(frame, most):
        got.update((r.word, r.other) for r in near_pairs(keyed).collect())
    assert got == Counter((a, b) for a in words for b in words if edited(a, b))


@pytest.mark.parametrize("most", [3, 1000])
def test_variants(spark, most):
    choice = random.Random(7)
    counts = {w: 3 ** choice.randint(0, 12) for w in random_words(2, 500, 1, 6)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert Counter(map(tuple, variants(frame, most=most).collect())) == brute(counts)


def test_long_chain_of_forms(spark):
    chain = [("x" * k, f"{'x' * (k + 1)}") for k in range(1, 19)]
    got = dict(map(tuple, rooted(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {w: "x" * 19 for w, _ in chain}


def counted(rows):
    out: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 7:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= 2}


def test_vocabulary_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 3)
    text = "Àccenté×÷ accENTED accented a_b 1.separate,separate İstanbul istanbulı übergang Übergang"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (None, "accented"), (4, "\n\t"), (5, "q" * 70_000 + " " + text)]
    rows += [(k, "accented accentet separate") for k in range(100, 240)]
    frame = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    expected = counted(rows)
    assert dict(map(tuple, vocabulary(frame).collect())) == expected
    assert Counter(map(tuple, variants(vocabulary(frame)).collect())) == brute(expected)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert variants(vocabulary(none)).count() == 0


def test_against_sql(spark):
    got = spelling.op11(spark, TEST_FOLDER)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{TEST_FOLDER}/documents.parquet')")
    names = sorted(got.columns)
    expected = con.execute(f"select {', '.join(names)} from ({common.SQL['op11_spelling']})").fetchall()
    assert len(expected) > 100 and Counter(map(tuple, got.select(*names).collect())) == Counter(expected)
